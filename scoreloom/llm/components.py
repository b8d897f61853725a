"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.plans.staging import release, stage


def _towards_least(edges: DataFrame) -> DataFrame:
    """One round: larger neighbours of every node point at the least node of its neighbourhood, then smaller ones do.

    Every row of ``edges`` points from a larger node ``u`` to a smaller one, and so does every row of the result.
    """
    both = edges.selectExpr("inline(array(struct(u AS k, v AS n), struct(v AS k, u AS n)))")
    least = both.groupBy("k").agg(F.min("n").alias("n")).selectExpr("k", "least(k, n) AS m")
    # Equal rows may stay until the end: telling them apart here takes one more shuffle than it saves.
    large = edges.join(least, F.col("v") == F.col("k")).select("u", F.col("m").alias("v"))
    low = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    small = large.join(low, F.col("u") == F.col("k"))
    return small.selectExpr("inline(array_compact(array(struct(u, m AS v), CASE WHEN v <> m THEN struct(v AS u, m AS v) END)))").distinct()


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node points at two others, or at one while another points at it."""
    ends = edges.selectExpr("inline(array(struct(u AS node, 1L AS down, 0L AS up), struct(v AS node, 0L AS down, 1L AS up)))")
    return not ends.groupBy("node").agg(F.sum("down").alias("down"), F.sum("up").alias("up")).where("down > 1 OR down > 0 AND up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (u long, v long)``: the least node it reaches.

    Alternating large-star and small-star rounds, each two joins on a node
    with sums made before the shuffle. Rounds grow with the logarithm of the
    longest chain, and end when every node points at its least one; that is
    counted node by node, which takes a fraction of a round. Every round is a
    written table, so nothing is recomputed if an executor is lost. Nodes
    without an edge are not in the result; no edges, no rows.
    """
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while _unsettled(now):
        then = stage(_towards_least(now), "edges")
        release(now)
        now = then
    heads = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads)
