"""Standardised features, principal components and the weights they suggest."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.config import Scorecard
from scoreloom.functions.expressions import col, named, num, percent_text, round_half_even
from scoreloom.functions.literals import small_table


def standardise(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Mean 0 and population deviation 1 over the whole table; 0 without a spread."""
    moments = df.selectExpr(
        *(
            named(f"{function}({col(c)})", f"{c}_{name}")
            for c in columns
            for name, function in (("mean", "avg"), ("dev", "stddev_pop"))
        )
    )
    row = moments.first()

    def z(c: str) -> str:
        mean, dev = row[f"{c}_mean"], row[f"{c}_dev"]
        return f"{col(c)} * 0D" if dev == 0 else f"({col(c)} - {num(mean)}) / {num(dev)}"

    return df.selectExpr(*map(col, keep), *(named(z(c), c) for c in columns))


def assemble(df: DataFrame, columns: Sequence[str], incomplete: str = "error") -> DataFrame:
    """Add the vector column ``features``; rows with nulls raise, or are skipped."""
    return VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid=incomplete
    ).transform(df)


def fit_components(normalised: DataFrame, card: Scorecard, k: int = 3, incomplete: str = "error") -> PCAModel:
    """Principal components of the standardised metrics.

    ``normalised`` holds the 0..1 metrics. A principal component needs complete
    rows: ``incomplete`` is ``"error"`` or ``"skip"``. Only the covariance
    matrix, as wide as the registry, reaches the driver.
    """
    columns = card.metric_columns
    if incomplete == "skip":
        normalised = normalised.na.drop(subset=columns)
    vectors = assemble(standardise(normalised, columns, []), columns)
    return PCA(k=k, inputCol="features", outputCol="components").fit(vectors.select("features"))


def variance_table(model: PCAModel, spark) -> DataFrame:
    """Rows ``(component, explained)``, the share of total variance."""
    shares = model.explainedVariance.toArray().tolist()
    return small_table(
        spark, [(f"PC{i}", s) for i, s in enumerate(shares, 1)], "component string, explained double"
    )


def loadings_table(model: PCAModel, card: Scorecard, spark) -> DataFrame:
    """Rows ``(component, metric, pillar, loading)``.

    The sign of a component is arbitrary; here its largest loading by amount,
    the first of equals, is positive.
    """
    matrix = model.pc.toArray()
    largest = np.abs(matrix).round(9).argmax(axis=0)
    signs = np.where(matrix[largest, np.arange(matrix.shape[1])] < 0, -1.0, 1.0)
    rows = [
        (f"PC{j + 1}", m.column, card.pillar_label(m.pillar), float(matrix[i, j] * signs[j]))
        for i, m in enumerate(card.metrics)
        for j in range(matrix.shape[1])
    ]
    return small_table(spark, rows, "component string, metric string, pillar string, loading double")


def pillar_affinity(loadings: DataFrame) -> DataFrame:
    """Mean absolute loading of every pillar on every component."""
    return loadings.groupBy("component", "pillar").agg(F.avg(F.abs("loading")).alias("affinity"))


def dominant_pillars(affinity: DataFrame) -> DataFrame:
    """The pillar of highest affinity per component; ties by name."""
    best = Window.partitionBy("component").orderBy(F.desc("affinity"), F.asc("pillar"))
    return (
        affinity.withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") == 1)
        .select("component", F.col("pillar").alias("dominant_pillar"))
    )


def component_table(variance: DataFrame, loadings: DataFrame) -> DataFrame:
    """Components with their explained share, in percent and exact, and dominant pillar."""
    return variance.join(dominant_pillars(pillar_affinity(loadings)), "component").select(
        "component",
        F.expr(named(round_half_even("explained * 100"), "explained_variance_pct")),
        "dominant_pillar",
        "explained",
    )


def weight_table(components: DataFrame, card: Scorecard) -> DataFrame:
    """Each pillar's share of the explained variance its components carry.

    A pillar that dominates no component gets 0.
    """
    pillars = small_table(
        components.sparkSession,
        [(p.slug, p.label, float(p.weight)) for p in card.pillars],
        "slug string, pillar string, fixed_weight double",
    )
    carried = components.groupBy("dominant_pillar").agg(F.sum("explained").alias("carried"))
    total = components.agg(F.sum("explained")).scalar()
    weight = F.coalesce("carried", F.lit(0.0)) / total
    return (
        pillars.join(carried, F.col("pillar") == F.col("dominant_pillar"), "left")
        .withColumn("weight", weight)
        .select(
            "slug",
            "pillar",
            "weight",
            F.expr(named(percent_text("weight"), "weight_text")),
            "fixed_weight",
        )
    )
