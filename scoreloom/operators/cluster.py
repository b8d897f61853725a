"""K-means over pillar scores, silhouettes, and the choice of k."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.literals import small_table
from scoreloom.functions.lloyd import centre_sums
from scoreloom.functions.tiles import SUMS_SCHEMA, tile_pair
from scoreloom.plans.staging import stage

# The range of k, the restarts, the first seed, and when a fit is
# done: the squared moves of all centres add up to less than MOVE.
CLUSTER_COUNTS = (2, 3, 4, 5, 6)
RESTARTS = 10
FIRST_SEED = 42
MAX_ITERATIONS = 300
MOVE = 1e-4

# Rounds of the k-means|| start, and how many distinct points lie in a partition:
# fixed, as a fit depends on both. The start draws anew in every partition, from
# seeds that are alike, so points must not be spread thinly.
INIT_STEPS = 5
LAYOUT_ROWS = 100_000

# Points that are worth a task of a round.
_ROUND_ROWS = 25_000

# Kinds of silhouette: a linear pass, or every distance.
SQUARED, EUCLIDEAN = "squared_euclidean", "euclidean"


@dataclass(frozen=True)
class Fit:
    k: int
    cost: float
    model: KMeansModel


def _move(points: DataFrame, centres: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """One round of K-means for many sets of centres in one pass: where each moves, and the cost before.

    ``points`` holds ``x`` (array<double>) and ``weight``. Only sums per set and
    cluster leave a task. A centre without points stays where it is.
    """
    width = centres[0].shape[1]
    sums = [f"s{i}" for i in range(width)]
    schema = "fit int, cluster int, weight double, cost double, " + ", ".join(f"{s} double" for s in sums)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = ((b.column("x").flatten().to_numpy().reshape(-1, width), b.column("weight").to_numpy()) for b in batches)
        yield pa.RecordBatch.from_pydict(centre_sums(arrays, centres))

    found = points.mapInArrow(of_batches, schema).groupBy("fit", "cluster").agg(*(F.sum(c).alias(c) for c in ("weight", "cost", *sums)))
    moved, costs = [c.copy() for c in centres], [0.0] * len(centres)
    # One row per set and cluster, whatever the number of points.
    for r in found.collect():
        costs[r.fit] += r.cost
        if r.weight > 0:
            moved[r.fit][r.cluster] = [r[s] / r.weight for s in sums]
    return list(zip(moved, costs))


def _costs(points: DataFrame, starts: Sequence[np.ndarray], tols: Sequence[float]) -> list[float]:
    """The cost that K-means reaches from every start; those still moving share a pass a round."""
    centres, costs, moving = list(starts), [math.inf] * len(starts), list(range(len(starts)))
    for _ in range(MAX_ITERATIONS):
        going = []
        for i, (moved, cost) in zip(moving, _move(points, [centres[i] for i in moving])):
            if (((moved - centres[i]) ** 2).sum(axis=1) > tols[i] ** 2).any():
                going.append(i)
            centres[i], costs[i] = moved, cost
        moving = going
        if not moving:
            break
    return costs


def best_fits(
    points: DataFrame,
    ks: Iterable[int] = CLUSTER_COUNTS,
    restarts: int = RESTARTS,
    parallelism: int = 8,
    layout_rows: int = LAYOUT_ROWS,
) -> list[Fit]:
    """The cheapest of ``restarts`` K-means models for every k.

    ``points`` holds distinct ``features`` and their ``weight``, so copies cost
    nothing. MLlib draws every start; all of them are then followed to their end
    together, a pass over the points a round, and MLlib fits the cheapest of
    every k. The starts and fits are independent jobs; a few run side by side.
    Points are dealt by hash into sorted partitions first, one for every
    ``layout_rows`` of them, so the fits do not depend on how they came. The
    start draws anew in every partition: with other numbers of partitions other
    restarts are tried, and the best of them may be another one. No fit is a
    matter of the rows alone.
    """
    ks = list(ks)
    place = vector_to_array("features")
    rows = points.count()
    parts = max(1, math.ceil(rows / layout_rows))
    points = points.select("features", "weight").repartition(parts, place).sortWithinPartitions(place).persist()
    # Rounds may deal the points as they like: enough tasks for all cores, none of them too small.
    spread = max(parts, min(2 * points.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / _ROUND_ROWS)))
    arrays = points.select(place.alias("x"), "weight").repartition(spread).persist()

    # The centres together move less than MOVE when each moves less than this.
    tols = {k: math.sqrt(MOVE / k) for k in ks}

    def fit(k: int, seed: int, rounds: int = MAX_ITERATIONS) -> KMeansModel:
        return KMeans(
            k=k, seed=seed, maxIter=rounds, tol=tols[k], initSteps=INIT_STEPS, featuresCol="features", weightCol="weight"
        ).fit(points)

    tries = [(k, FIRST_SEED + i) for k in ks for i in range(restarts)]
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            # Each task needs its own copy of the session's thread-local state.
            inherit = inheritable_thread_target(points.sparkSession)
            if restarts > 1:
                running = [pool.submit(inherit(fit), *t, 0) for t in tries]
                starts = [np.array(r.result().clusterCenters()) for r in running]
                costs = _costs(arrays, starts, [tols[k] for k, _ in tries])
            else:
                costs = [0.0] * len(tries)
            best = [min((t for t in zip(costs, tries) if t[1][0] == k), key=lambda t: t[0])[1] for k in ks]
            running = [pool.submit(inherit(fit), *t) for t in best]
            models = [r.result() for r in running]
            return [Fit(k, m.summary.trainingCost, m) for k, m in zip(ks, models)]
    finally:
        arrays.unpersist()
        points.unpersist()


def label_points(points: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """Add one label column ``k{n}`` per fit."""
    for f in fits:
        points = f.model.setFeaturesCol("features").setPredictionCol(f"k{f.k}").transform(points)
    return points


# --- Silhouette, Euclidean and exact ---------------------------------------

_TILE_ROWS = 4096


def _tiles_for(rows: int, slots: int) -> int:
    """Tiles of bounded size, and enough pairs of them to keep all slots busy."""
    by_size = math.ceil(rows / _TILE_ROWS)
    by_slots = math.ceil(math.sqrt(2 * slots))
    return max(1, by_size, min(by_slots, math.ceil(rows / 256)))


def euclidean_silhouette(points: DataFrame, sweeps: Sequence[str]) -> DataFrame:
    """Mean Euclidean silhouette of each label column, over all points.

    ``points`` holds ``features`` (array<double>), ``weight`` and one label column per sweep, one row
    per distinct point and labelling. Every distance counts, so the work is
    quadratic; it is cut into pairs of tiles of bounded size, each computed in
    one go for all sweeps, and only per-cluster sums leave a task. A point alone
    in its cluster scores 0; with a single cluster the result is null.
    """
    spark = points.sparkSession
    held = stage(
        points.select(
            F.monotonically_increasing_id().alias("point"),
            "features",
            F.col("weight").cast("double").alias("weight"),
            *(F.col(s).cast("long").alias(s) for s in sweeps),
        ),
        "silhouette-points",
    )
    rows = held.count()
    tiles = _tiles_for(rows, spark.sparkContext.defaultParallelism)
    tiled = held.withColumn("tile", F.pmod(F.xxhash64("point"), F.lit(tiles)).cast("int"))
    paired = tiled.withColumn("partner", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        "*", F.least("tile", "partner").alias("lo"), F.greatest("tile", "partner").alias("hi")
    )

    def sums_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return tile_pair(*key, rows, sweeps)

    # Little data but much work per tile pair: ask for enough tasks outright.
    tasks = min(tiles * (tiles + 1) // 2, 4 * spark.sparkContext.defaultParallelism)
    sums = (
        paired.repartition(tasks, "lo", "hi")
        .groupBy("lo", "hi")
        .applyInPandas(sums_of, SUMS_SCHEMA)
        .repartition("point")
    )
    clusters = sums.groupBy("point", "sweep", "own", "weight", "cluster").agg(
        F.sum("distance").alias("distance"), F.sum("members").alias("members")
    )
    home, away = F.col("cluster") == F.col("own"), F.col("cluster") != F.col("own")
    sides = clusters.groupBy("point", "sweep", "weight").agg(
        F.max(F.when(home & (F.col("members") > 1), F.col("distance") / (F.col("members") - 1))).alias("a"),
        F.min(F.when(away, F.col("distance") / F.col("members"))).alias("b"),
        F.max(F.when(home, F.col("members"))).alias("size"),
    )
    a, b = F.col("a"), F.col("b")
    widest = F.greatest(a, b)
    width = (
        F.when(b.isNull(), F.lit(None))
        .when(F.col("size") <= 1, F.lit(0.0))
        .when(widest == 0, F.lit(0.0))
        .otherwise((b - a) / widest)
    )
    return sides.groupBy("sweep").agg(
        (F.sum(width * F.col("weight")) / F.sum(F.when(b.isNotNull(), F.col("weight")))).alias("silhouette")
    )


def squared_silhouette(rows: DataFrame, sweep: str) -> float:
    """Mean silhouette under squared Euclidean distance: one linear pass.

    ``rows`` are single rows. The evaluator would not count a weighted point as
    that many copies, so weights are of no use here.
    """
    return ClusteringEvaluator(
        featuresCol="features", predictionCol=sweep, distanceMeasure="squaredEuclidean"
    ).evaluate(rows)


@dataclass(frozen=True)
class Sweep:
    """The outcome of a k sweep: one row of figures per k, and the chosen fit."""

    table: DataFrame
    best: Fit
    silhouettes: dict[int, float]
    kind: str
    fits: tuple[Fit, ...] = ()


def choose_k(silhouettes: dict[int, float]) -> tuple[dict[int, float], int]:
    """Silhouettes rounded to three places, and the k of the highest; ties go to the smaller k."""
    rounded = {k: round(s, 3) for k, s in silhouettes.items()}
    return rounded, min(rounded, key=lambda k: (-rounded[k], k))


def sweep_clusters(
    points: DataFrame,
    rows: DataFrame,
    ks: Sequence[int] = CLUSTER_COUNTS,
    restarts: int = RESTARTS,
    silhouette: str = SQUARED,
) -> Sweep:
    """Fit every k, score the fits and choose.

    ``rows`` holds the ``features`` of every row, ``points`` those that differ,
    with their weight. ``silhouette`` is the caller's choice, whatever the number of rows:
    "squared_euclidean" is one linear pass over all rows, "euclidean" takes every
    distance and is quadratic. Silhouettes are rounded to three places before
    the highest is taken; ties go to the smaller k. Every k needs more distinct
    points than clusters.
    """
    if silhouette not in (SQUARED, EUCLIDEAN):
        raise ValueError(f"silhouette is {SQUARED!r} or {EUCLIDEAN!r}, not {silhouette!r}")
    spark, kind = points.sparkSession, silhouette
    distinct = points.count()
    if max(ks) >= distinct:
        raise ValueError(f"k = {max(ks)} needs more than {max(ks)} distinct points; there are {distinct}")
    fits = best_fits(points, ks, restarts)
    sweeps = [f"k{f.k}" for f in fits]
    if kind == EUCLIDEAN:
        arrays = label_points(points, fits).withColumn("features", vector_to_array("features"))
        found = {r["sweep"]: r["silhouette"] for r in euclidean_silhouette(arrays, sweeps).collect()}
    else:
        held = stage(label_points(rows.select("features"), fits), "labelled-rows")
        found = {s: squared_silhouette(held, s) for s in sweeps}
    rounded, chosen = choose_k({f.k: found[f"k{f.k}"] for f in fits})
    best = next(f for f in fits if f.k == chosen)
    table = small_table(
        spark,
        [(f.k, float(f.cost), rounded[f.k], kind, f is best) for f in fits],
        "k int, cost double, silhouette double, silhouette_kind string, chosen boolean",
    )
    return Sweep(table, best, rounded, kind, tuple(fits))


def weigh_points(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Distinct points with the number of rows at each."""
    return df.groupBy(*features, *keep).agg(F.count(F.lit(1)).cast("double").alias("weight"))
