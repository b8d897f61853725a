"""Exact top-k search by inner product, as a Voronoi join.

Vectors are quantised to integers, so scores are exact. Pivots cut the space
into cells; queries and data go to the cell of the nearest pivot. A cell's
summary is its radius and its k + 1 least distances to the pivot. For a vector x
at distance d from pivot p, the product q.x lies within |q| d of q.p. Hence

- the summaries promise a query (k + 1) products of at least some bound, own
  row included, and likewise every query of a group at once;
- a cell whose greatest possible product stays below that bound is not needed.

Bounds by group rule out cells first. Then the queries go in two rounds: each to
the cell that may hold its greatest product, which gives it a real k-th score; and
from there only to those cells that may still beat it. Cells are split into blocks
and their queries into chunks, so a task holds one block and one chunk whatever a
hot cell has. Pivots grow with the root of the number of rows, so cells do too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.plans.staging import release, stage

SCALE = 64
K = 20
# Pivots are the rows with the least hashes, as many as the root of all rows within
# these bounds; they decide how much is pruned, never the result.
LEAST_PIVOTS, MOST_PIVOTS = 64, 1024
BLOCK = 8192  # data rows of a task
CHUNK = 2048  # queries of a task
CELLS = 1 << 22  # bounds looked at together
WHOLE = 1 << 62  # no component may be as large
_BEST = "query long, query_id long, rid long, vec_id long, bare boolean, score long"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``rid, vec_id, v``: floor(scale * x) of every component, padded with zeros to one length.

    Every row is its own and has a number ``rid``, those that repeat a vec_id or
    have none included. Vectors that are null, or hold a null or non-finite
    component, are left out. A component of 2**62 or more, scaled, raises.
    """
    whole = vectors.selectExpr("CAST(vec_id AS bigint) AS vec_id", "CAST(embedding AS array<double>) AS x").where(
        "x IS NOT NULL AND forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('Infinity'))"
    )
    fits = f"CASE WHEN abs({scale}D * e) < double({WHOLE}) THEN bigint(floor({scale}D * e)) ELSE bigint(raise_error('a component passes 62 bits')) END"
    made = whole.selectExpr("vec_id", f"transform(x, e -> {fits}) AS v").withColumn("rid", F.monotonically_increasing_id())
    made = stage(made, "quantised")  # written once: the numbers must not change any more
    width = made.agg(F.max(F.size("v"))).first()[0] or 0
    return made.selectExpr("rid", "vec_id", f"CASE WHEN size(v) < {width} THEN concat(v, array_repeat(0L, {width} - size(v))) ELSE v END AS v")


def _matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _cells(pivots: np.ndarray):
    """Each vector's nearest pivot and its distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // len(pivots))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                x = _matrix(batch.column(2))
                gap = np.maximum((x * x).sum(1)[:, None] - 2 * (x @ pivots.T) + (pivots * pivots).sum(1), 0)
                cell = gap.argmin(1)
                near = np.linalg.norm(x - pivots[cell], axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(near, pa.float64())], names=["rid", "vec_id", "v", "cell", "far"])

    return run


def _slack(x: np.ndarray) -> np.ndarray:
    """Rounding of the bounds, generously."""
    return 1e-6 + 1e-9 * np.abs(x)


def _kth(low: np.ndarray, k: int) -> np.ndarray:
    """The (k + 1)-th greatest of every row; minus infinity where there are fewer."""
    if low.shape[1] <= k:
        return np.full(len(low), -np.inf)
    return np.partition(low, -(k + 1), axis=1)[:, -(k + 1)]


def _group_needs(pivots: np.ndarray, radius: np.ndarray, reach: np.ndarray, nearest: list[tuple[int, float]], k: int) -> np.ndarray:
    """Which cells (columns) may hold results of a query group (rows); radius -1: an empty cell."""
    dot, size = pivots @ pivots.T, np.linalg.norm(pivots, axis=1)
    long = (size + np.maximum(reach, 0))[:, None]  # no query of the group is longer
    cell = np.array([c for c, _ in nearest], np.int64)
    far = np.array([d for _, d in nearest])
    low = dot[:, cell] - reach.clip(0)[:, None] * size[cell] - long * far
    high = dot + reach.clip(0)[:, None] * size + long * radius.clip(0)
    bound = _kth(low, k)[:, None]
    return (high + _slack(high) >= bound - _slack(np.nan_to_num(bound, neginf=0))) & (radius >= 0)


def _routes(pivots: np.ndarray, radius: np.ndarray, nearest: list[tuple[int, float]], needs: np.ndarray, k: int, first: bool):
    """The cells each query needs: first the most promising one, later the others that may beat its k-th score."""
    cell = np.array([c for c, _ in nearest], np.int64)
    far = np.array([d for _, d in nearest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // max(1, len(cell)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                q, group = _matrix(batch.column(2)), batch.column(3).to_numpy()
                dot, long = q @ pivots.T, np.linalg.norm(q, axis=1)[:, None]
                bound = _kth(dot[:, cell] - long * far, k)[:, None]
                high = dot + long * radius.clip(0)
                may = (high + _slack(high) >= bound - _slack(np.nan_to_num(bound, neginf=0))) & needs[group]
                if first:
                    row = np.flatnonzero(may.any(1))
                    to = np.where(may, high, -np.inf).argmax(1)[row]
                else:
                    done = batch.column(4).to_numpy()[:, None]
                    kth = batch.column(5).cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy()[:, None]
                    may &= (high + _slack(high) >= kth - _slack(np.nan_to_num(kth, neginf=0))) & (np.arange(len(pivots)) != done)
                    row, to = np.nonzero(may)
                own = pa.array(row)
                least = pa.nulls(len(row), pa.int64()) if first else batch.column(5).take(own)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(own) for i in range(3)), pa.array(to, pa.int32()), least], names=["query", "query_id", "q", "cell", "kth"])

    return run


def _solved(k: int):
    """The k best of a block for every query of a chunk."""
    names = ["query", "query_id", "rid", "vec_id", "bare", "score"]

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        if not len(queries) or not len(data):
            empty = pa.array([], pa.int64())
            return pa.Table.from_arrays([empty, empty, empty, empty, pa.array([], pa.bool_()), empty], names=names)
        asked, rid = queries["query"].to_numpy(), data["rid"].to_numpy()
        bare = data["vec_id"].is_null().to_numpy()
        ids = data["vec_id"].fill_null(0).to_numpy()
        q, x = _matrix(queries["q"], np.int64), _matrix(data["v"], np.int64)
        most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
        if most >= 2**63:
            raise ValueError("inner products may pass 63 bits")
        # Doubles multiply exactly while no sum passes 2**53.
        score = np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64) if most < 2**53 else q @ x.T
        # What stays below the k-th score that a query has already is of no use.
        own = (asked[:, None] == rid[None, :]) | (score < queries["kth"].fill_null(np.iinfo(np.int64).min).to_numpy()[:, None])
        if len(ids) > k + 1:
            masked = np.where(own, np.iinfo(np.int64).min, score)
            own |= masked < np.partition(masked, -k, axis=1)[:, -k][:, None]
        row, col = np.nonzero(~own)
        value = score[row, col]
        order = np.lexsort((ids[col], bare[col], -value, row))
        row, col, value = row[order], col[order], value[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, col, value = row[best], col[best], value[best]
        columns = (asked[row], queries["query_id"].to_numpy()[row], rid[col], ids[col], bare[col], value)
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _joined(routed: DataFrame, placed: DataFrame, rows: np.ndarray, k: int) -> DataFrame:
    """The k best of every query in each of its cells' blocks."""
    asked = dict(routed.groupBy("cell").count().collect())  # a row for each pivot
    blocks = "element_at(array({}), cell + 1)".format(", ".join(str(-(-int(n) // BLOCK) or 1) for n in rows))
    chunks = "element_at(array({}), cell + 1)".format(", ".join(str(-(-asked.get(c, 0) // CHUNK)) for c in range(len(rows))))
    left = routed.selectExpr("cell", f"int(pmod(xxhash64(query), {chunks})) AS chunk", f"explode(sequence(0, {blocks} - 1)) AS block", "query", "query_id", "q", "kth")
    right = placed.where(f"{chunks} > 0").selectExpr("cell", f"explode(sequence(0, {chunks} - 1)) AS chunk", f"int(pmod(xxhash64(rid, 1), {blocks})) AS block", "rid", "vec_id", "v")
    task = ["cell", "chunk", "block"]
    return left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_solved(k), _BEST)


def top_k(vectors: DataFrame, is_query: str, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best products of every query row with all other rows.

    ``is_query`` is a condition on ``vec_id``; every row that fulfils it is a query
    of its own, and every row but itself a candidate, those that repeat its vec_id
    included. Ties go to the smaller vec_id, a null one last; a query with fewer
    than ``k`` partners gets them all. See ``quantised`` for the vectors that take
    part. Products that may not fit 63 bits raise. Other columns are ignored, no
    queries or no rows give no result.
    """
    whole = quantised(vectors, scale)
    n = whole.count()
    pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.isqrt(n)))
    sample = whole.orderBy(F.xxhash64("vec_id", "rid"), "rid").limit(pivots).select("v").collect()  # MOST_PIVOTS rows at most
    if not sample:
        return whole.selectExpr("vec_id AS query_id", "0 AS rank", "vec_id", "0L AS score").where("false")
    pivots = np.array([r.v for r in sample], np.float64).reshape(len(sample), -1)
    placed = stage(whole.mapInArrow(_cells(pivots), "rid long, vec_id long, v array<long>, cell int, far double"), "cells")

    radius, reach, rows = np.full(len(pivots), -1.0), np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    for cell, held, most, query_most in placed.groupBy("cell").agg(F.count(F.lit(1)), F.max("far"), F.expr(f"max(CASE WHEN {is_query} THEN far END)")).collect():  # a row for each pivot
        rows[cell], radius[cell], reach[cell] = held, most, -1.0 if query_most is None else query_most
    close = Window.partitionBy("cell").orderBy("far")
    nearest = placed.select("cell", "far", F.row_number().over(close).alias("place")).where(F.col("place") <= k + 1).select("cell", "far")
    nearest = [(r.cell, r.far) for r in nearest.collect()]  # MOST_PIVOTS * (k + 1) rows at most
    needs = _group_needs(pivots, radius, reach, nearest, k)

    queries = placed.where(is_query).select("rid", "vec_id", "v", "cell")
    shape = "query long, query_id long, q array<long>, cell int, kth long"
    routed = stage(queries.mapInArrow(_routes(pivots, radius, nearest, needs, k, True), shape), "first-routes")
    found = stage(_joined(routed, placed, rows, k), "first-found")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    # One row a query: the k-th score it has, if it has as many.
    kth = found.withColumn("place", place).where(F.col("place") == k).select(F.col("query").alias("rid"), F.col("score").alias("kth"))
    done = routed.select(F.col("query").alias("rid"), F.col("cell").alias("done"))
    begun = queries.join(done, "rid").join(kth, "rid", "left").select("rid", "vec_id", "v", "cell", "done", "kth")
    later = stage(begun.mapInArrow(_routes(pivots, radius, nearest, needs, k, False), shape), "later-routes")
    every = stage(found.union(_joined(later, placed, rows, k)), "found")
    release(routed, later, found)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("bare"), F.asc("vec_id"))
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.selectExpr("query_id", "rank", "CASE WHEN NOT bare THEN vec_id END AS vec_id", "score")
