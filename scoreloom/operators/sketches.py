"""Quantiles and distinct counts that merge: stored sketches instead of stored rows.

A day, a file or a group of rows leaves one sketch of bounded size, in a row like
any other. Later ones are merged without reading the rows again, in any order.
The sketches are Spark's own (KLL for quantiles, HLL for distinct values), so they
are built map-side and travel as a few kilobytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.expressions import col, named, num, text

# Sizes: entries a KLL sketch keeps per level, and the logarithm of HLL's registers.
KLL_SIZE = 800
HLL_BITS = 14


def rank_error(size: int = KLL_SIZE) -> float:
    """How far, as a share of all rows, the rank of a sketched quantile is from the one asked for.

    Twice the error that a KLL sketch of this size stays below in 99 of 100 cases.
    """
    return 2 * 2.296 / size**0.9021


def count_error(bits: int = HLL_BITS) -> float:
    """How far, as a share of itself, a sketched distinct count is off: three standard errors."""
    return 3 * 1.04 / 2 ** (bits / 2)


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = KLL_SIZE) -> DataFrame:
    """``by..., metric, n, sketch``: one sketch of every column per group of ``by``; nulls and NaN do not count.

    A column without values in a group has n 0 and a null sketch.
    """
    values = df.selectExpr(*map(col, by), *(named(f"nullif(double({col(c)}), double('NaN'))", c) for c in columns))
    cells = [
        F.struct(F.lit(c).alias("metric"), F.count(c).alias("n"), F.when(F.count(c) > 0, F.kll_sketch_agg_double(c, F.lit(size))).alias("sketch"))
        for c in columns
    ]
    return values.groupBy(*by).agg(F.array(*cells).alias("cells")).select(*by, F.inline("cells"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts as those of the whole, per group of ``by`` and metric."""
    return sketches.groupBy(*by, "metric").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``..., metric, n, prob, value`` out of sketches; those without values have no rows."""
    keep = [c for c in sketches.columns if c != "sketch"]
    asked = ", ".join(map(num, probs))
    return sketches.where("n > 0").selectExpr(
        *map(col, keep), f"inline(zip_with(array({asked}), kll_sketch_get_quantile_double(sketch, array({asked})), (p, v) -> struct(p AS prob, v AS value)))"
    )


def quantiles_within(df: DataFrame, columns: Sequence[str], found: DataFrame, error: float) -> DataFrame:
    """``found (metric, n, prob, value)`` with ``within``: the rank of the value is as near as ``error`` says.

    One pass counts the rows below and up to every value; ``found`` is as long as
    the registry times the quantiles asked for.
    """
    values = found.select("metric", "prob", "value").collect()
    x = {c: f"double({col(c)})" for c in columns}
    cells = ", ".join(
        f"struct({text(r.metric)} AS metric, {num(r.prob)} AS prob, count_if({x[r.metric]} < {num(r.value)}) AS less, count_if({x[r.metric]} <= {num(r.value)}) AS upto)"
        for r in values
    )
    if not values:
        return found.withColumn("within", F.lit(True))
    counted = df.agg(F.expr(f"array({cells})").alias("cells")).select(F.inline("cells"))
    slack = f"({num(error)} * n + 1)"
    near = F.expr(f"less <= prob * n + {slack} AND upto >= prob * n - {slack}")
    return found.join(F.broadcast(counted), ["metric", "prob"]).withColumn("within", near).select(*found.columns, "within")


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bits: int = HLL_BITS) -> DataFrame:
    """``by..., rows, column, sketch``: the distinct values of every column per group of ``by``, nulls aside.

    Columns are sketched as text, so that files with other types still merge.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(bits)).alias("sketch")) for c in columns]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.array(*cells).alias("cells")).select(*by, "rows", F.inline("cells"))


def merged_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, parts, rows, distinct_values`` of the union of the sketched parts."""
    return sketches.groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )
