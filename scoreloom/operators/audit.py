"""Checks that a clustering is what it claims to be, without fitting anything again.

A K-means result is a fixpoint: every point belongs to the nearest centre, and
every centre is the mean of its points. Both are looked at by joining the points
with a table of the centres, so a check costs two passes whatever fitted them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.config import Scorecard
from scoreloom.functions.expressions import col, num
from scoreloom.functions.literals import small_table
from scoreloom.operators.cluster import MOVE, Fit, label_points
from scoreloom.plans.staging import release, stage

# Distances that differ by less are equal: rounding of sums over the coordinates.
EQUAL = 1e-9


def centre_table(spark, fits: Sequence[Fit]) -> DataFrame:
    """``k, centres``: a row for each fit, with the coordinates of its centres by label."""
    rows = [(f.k, [c.tolist() for c in f.model.clusterCenters()]) for f in fits]
    return small_table(spark, rows, "k int, centres array<array<double>>")


def audit_fits(points: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """``k, points, weight, misplaced, off_centre, empty`` for every fit over ``points (features, weight)``.

    ``misplaced`` points are nearer another centre than their own, ``off_centre``
    counts centres farther from the mean of their points than the last move that
    the fit allows, ``empty`` those without a point. ``weight`` adds up what the
    clusters hold, so it must equal the number of rows. No fits or no points give
    no rows.
    """
    spark = points.sparkSession
    if not fits:
        return small_table(spark, [], "k int, points long, weight long, misplaced long, off_centre long, empty long")
    arrays = label_points(points, fits).withColumn("x", vector_to_array("features"))
    labels = ", ".join(f"struct({f.k} AS k, int(k{f.k}) AS label)" for f in fits)
    width = len(fits[0].model.clusterCenters()[0])
    far = "aggregate(zip_with(x, c, (a, b) -> (a - b) * (a - b)), 0D, (s, d) -> s + d)"
    placed = (
        arrays.selectExpr("x", "weight", f"inline(array({labels}))")
        .join(F.broadcast(centre_table(spark, fits)), "k")  # one row a fit
        .selectExpr("k", "label", "weight", "x", f"transform(centres, c -> {far}) AS far", "centres[label] AS centre")
    )
    # Sums of each coordinate, combined before the one shuffle of k * clusters rows.
    clusters = placed.groupBy("k", "label", "centre").agg(
        F.count(F.lit(1)).alias("points"),
        F.sum("weight").alias("weight"),
        F.count_if(F.expr(f"far[label] > array_min(far) + {EQUAL!r}D")).alias("misplaced"),
        F.array(*(F.sum(F.col("weight") * F.col("x")[i]) for i in range(width))).alias("sums"),
    )
    clusters = stage(clusters, "audited")
    gap = "aggregate(zip_with(sums, centre, (s, c) -> power(s / weight - c, 2)), 0D, (s, d) -> s + d)"
    # All centres together moved less than MOVE when the fit was done.
    allowed = "CASE k " + " ".join(f"WHEN {f.k} THEN {num(MOVE / f.k)}" for f in fits) + " END"
    return clusters.groupBy("k").agg(
        F.sum("points").alias("points"),
        F.sum("weight").cast("long").alias("weight"),
        F.sum("misplaced").alias("misplaced"),
        F.count_if(F.expr(f"{gap} > {allowed}")).alias("off_centre"),
        (F.col("k") - F.count(F.lit(1))).cast("long").alias("empty"),
    )


def audit_profiles(scores: DataFrame, profiles: DataFrame, card: Scorecard, cluster: str = "cluster_id") -> DataFrame:
    """``check, checked, wrong``: do numbered clusters, their profiles and the scores agree?

    - ``numbering``: clusters whose mean composite is below that of the number before;
    - ``sizes``: clusters whose profile counts another number of rows;
    - ``means``: profile means more than their rounding from the mean of the rows;
    - ``archetypes``: rows whose archetype is not that of their cluster's profile;
    - ``missing``: rows with complete pillars and no cluster.

    ``checked`` is the number of rows with complete pillars.
    """
    complete = " AND ".join(f"{col(s)} IS NOT NULL" for s in card.pillar_scores)
    composite = f"{card.score}_pca"
    means = {**{p.score: f"avg_{p.slug}" for p in card.pillars}, composite: f"avg_{card.name}"}
    held = stage(scores.select(cluster, "archetype", card.label, composite, *card.pillar_scores), "audited-scores")
    own = held.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        F.count(card.label).alias("rows"), *(F.avg(s).alias(f"mean_{i}") for i, s in enumerate(means))
    )
    # One row a cluster from here on.
    line = Window.orderBy(cluster)
    together = own.join(profiles.drop(card.plural), cluster, "full").withColumn("before", F.lag("mean_%d" % (len(means) - 1)).over(line))
    off = " OR ".join(f"abs(mean_{i} - {col(n)}) > 0.05 + {EQUAL!r}" for i, n in enumerate(means.values()))
    wrong = together.agg(
        F.count_if(F.expr(f"before > mean_{len(means) - 1} + 0.05")).alias("numbering"),
        F.count_if(F.expr(f"NOT (rows <=> {col(f'n_{card.plural}')})")).alias("sizes"),
        F.count_if(F.expr(off)).alias("means"),
    )
    names = profiles.select(cluster, F.col("archetype").alias("of_cluster"))
    strays = held.join(names, cluster, "left").agg(
        F.count_if(F.expr(complete)).alias("checked"),
        F.count_if(F.expr("NOT (archetype <=> of_cluster)")).alias("archetypes"),
        F.count_if(F.expr(f"{col(cluster)} IS NULL AND {complete}")).alias("missing"),
    )
    checks = ("numbering", "sizes", "means", "archetypes", "missing")
    figures = {**wrong.first().asDict(), **strays.first().asDict()}
    release(held)
    return small_table(scores.sparkSession, [(c, figures["checked"], figures[c]) for c in checks], "check string, checked long, wrong long")

