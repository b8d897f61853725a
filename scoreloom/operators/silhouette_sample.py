"""A Euclidean silhouette in linear time, with its standard error.

The exact measure takes every distance. Here each cluster gives a sample by a
hash of its rows' keys, and only sampled rows have a silhouette; but each of them
is measured against all rows, so its silhouette is exact. The mean over clusters,
weighted by their sizes, has a known standard error. The work is rows times
sample, and the sample is the caller's choice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.plans.staging import release, stage

SAMPLE = 200  # rows of a cluster, on average
MOST_SAMPLED = 100_000  # rows of the whole sample that may be sent to all tasks
ROWS = 256  # rows measured against the sample at once
_HASHES = 1 << 32


def _numbers(column: pa.Array) -> np.ndarray:
    """Arrays of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _summed(spots: np.ndarray, clusters: int):
    """Per task: distances from every sampled row to the rows of each cluster, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, size = np.zeros((len(spots), clusters)), np.einsum("ij,ij->i", spots, spots)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = _numbers(batch.column(0).slice(at, ROWS))
                label = batch.column(1).slice(at, ROWS).to_numpy()
                near = np.maximum(size[:, None] - 2 * (spots @ x.T) + np.einsum("ij,ij->i", x, x), 0)
                # Products lose the small distances, so these are taken again from the coordinates.
                rough = np.nonzero(near < 1e-6 * (1 + size[:, None]))
                near[rough] = ((spots[rough[0]] - x[rough[1]]) ** 2).sum(1)
                one_hot = np.zeros((len(label), clusters))
                one_hot[np.arange(len(label)), label] = 1
                sums += np.sqrt(near) @ one_hot
        point, cluster = np.indices(sums.shape)
        yield pa.RecordBatch.from_arrays([pa.array(point.ravel()), pa.array(cluster.ravel()), pa.array(sums.ravel())], names=["point", "cluster", "distance"])

    return run


def silhouette_by_sample(rows: DataFrame, label: str, key: str, sample: int = SAMPLE) -> DataFrame:
    """``label, rows, sampled, silhouette, standard_error`` for every cluster of ``rows (features, label, key)``.

    ``features`` is an array of doubles. A row is sampled if the md5 of its key, as
    a share of all md5s, is below ``sample / rows`` of its cluster, so a cluster of
    at most ``sample`` rows is taken whole and has no error. Equal keys are
    sampled together; keys should be unique. A cluster whose sample is empty or a
    single row of several has no standard error (null), as its spread is not known.
    Rows with a null are left out. A row alone in its cluster scores 0; with one
    cluster there is no silhouette. ``overall_silhouette`` puts clusters together.
    """
    spark = rows.sparkSession
    held = stage(
        rows.select(F.col("features").cast("array<double>").alias("features"), F.col(label).alias("label"), F.col(key).cast("string").alias("key")).na.drop(),
        "sampled-rows",
    )
    counts = {r["label"]: r["rows"] for r in held.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).collect()}  # a row a cluster
    names = sorted(counts)
    place = {n: i for i, n in enumerate(names)}
    schema = f"label {held.schema['label'].dataType.simpleString()}, rows long, sampled long, silhouette double, standard_error double"
    if not names:
        return spark.createDataFrame([], schema)
    spread = sum(min(sample, n) for n in counts.values())
    if spread > MOST_SAMPLED:
        raise ValueError(f"a sample of {sample} rows a cluster has {spread} rows; at most {MOST_SAMPLED} go to all tasks")
    index = F.create_map(*(F.lit(x) for n in names for x in (n, place[n])))
    share = F.create_map(*(F.lit(x) for n in names for x in (n, float(_HASHES) * sample / counts[n])))
    drawn = F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("double") < share[F.col("label")]
    spots = held.where(drawn).select("features", "label").collect()  # about ``sample`` rows a cluster
    at = [place[r["label"]] for r in spots]
    home = np.array(at, np.int64)
    if spots:
        points = np.array([r["features"] for r in spots], np.float64)
        numbered = held.select("features", index[F.col("label")].cast("int").alias("label"))
        sums = (
            numbered.mapInArrow(_summed(points, len(names)), "point long, cluster long, distance double")
            .groupBy("point", "cluster")
            .agg(F.sum("distance").alias("distance"))
            .collect()  # sampled rows times clusters
        )
        total = np.zeros((len(points), len(names)))
        for point, cluster, distance in sums:
            total[point, cluster] = distance
    else:
        total = np.zeros((0, len(names)))
    release(held)
    size = np.array([counts[n] for n in names], np.float64)
    every = np.arange(len(home))
    inner = total[every, home] / np.maximum(size[home] - 1, 1)
    outer = total / size
    outer[every, home] = np.inf
    near = outer.min(1, initial=np.inf)
    widest = np.maximum(inner, near)
    width = np.divide(near - inner, widest, out=np.zeros(len(home)), where=np.isfinite(widest) & (widest > 0))
    width = np.where(size[home] <= 1, 0.0, width)
    out = []
    for i, n in enumerate(names):
        own = width[home == i]
        mean = float(own.mean()) if len(own) and len(names) > 1 else None
        left = 1 - len(own) / size[i]  # of the cluster, not looked at
        error = 0.0 if left == 0 else float(np.sqrt(own.var(ddof=1) / len(own) * left)) if len(own) > 1 else None
        out.append((n, int(size[i]), len(own), mean, error if mean is not None else None))
    return spark.createDataFrame(out, schema)


def overall_silhouette(clusters: DataFrame) -> DataFrame:
    """``rows, sampled, silhouette, standard_error`` over the clusters that ``silhouette_by_sample`` gives.

    Clusters count by their rows. Null where a cluster has no silhouette, and the
    error where one has none.
    """
    whole = F.sum("rows")
    complete = F.count("silhouette") == F.count(F.lit(1))
    known = F.count("standard_error") == F.count(F.lit(1))
    return clusters.agg(
        whole.alias("rows"),
        F.sum("sampled").alias("sampled"),
        F.when(complete, F.sum(F.col("rows") * F.col("silhouette")) / whole).alias("silhouette"),
        F.when(known, F.sqrt(F.sum(F.pow(F.col("rows") * F.col("standard_error"), 2))) / whole).alias("standard_error"),
    )
