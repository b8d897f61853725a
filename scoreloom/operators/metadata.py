"""One-row tables that describe how scores came about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.config import RATING_EDGES, RATING_LETTERS, Scorecard
from scoreloom.functions.expressions import col, round_half_even

# The wording of the records.
VERSION = "1.0"
FRAMEWORK_NORMALISATION = "Min-max scaling within full universe; lower-is-better metrics inverted"
METHOD = "PCA-derived weights + K-Means clustering"
METHOD_NORMALISATION = "Min-max per metric, direction-corrected"


def _texts(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def framework_record(entities: DataFrame, card: Scorecard, scoring_date: str | None = None) -> DataFrame:
    """Weights, metrics, rating bands and the number of entities scored."""
    date = F.lit(scoring_date) if scoring_date else F.date_format(F.current_date(), "yyyy-MM-dd")
    pillars = F.struct(
        *(
            F.struct(
                F.lit(f"{p.weight:.0%}").alias("weight"),
                _texts(m.name for m in card.of_pillar(p.slug)).alias("metrics"),
            ).alias(p.label)
            for p in card.pillars
        )
    )
    letters = list(zip(RATING_LETTERS, RATING_EDGES, RATING_EDGES[1:]))
    rating_bands = F.struct(*(F.lit(f"{lo}–{hi}").alias(name) for name, lo, hi in reversed(letters)))
    return entities.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(VERSION).alias("version"),
        date.alias("scoring_date"),
        pillars.alias("pillars"),
        rating_bands.alias("rating_bands"),
        F.lit(FRAMEWORK_NORMALISATION).alias("normalisation"),
        F.col("n").alias(f"{card.plural}_scored"),
    )


def _as_map(table: DataFrame, key: str, value: Column) -> Column:
    """A table as short as the registry, as one map value."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), value.alias("value"))))
    return table.agg(F.map_from_entries(entries)).scalar()


def method_record(
    entities: DataFrame,
    card: Scorecard,
    components: DataFrame,
    weights: DataFrame,
    sweep: DataFrame,
    profiles: DataFrame,
    fiscal_year: int | None = None,
) -> DataFrame:
    """Components, derived weights, silhouettes and archetypes in one record."""
    pca = F.struct(
        components.agg(F.count(F.lit(1))).scalar().alias("n_components"),
        components.selectExpr(round_half_even("sum(explained) * 100")).scalar().alias("total_variance_explained_pct"),
        _as_map(weights, "pillar", F.col("weight_text")).alias("derived_weights"),
        F.struct(*(F.lit(f"{p.weight * 100:.1f}%").alias(p.label) for p in card.pillars)).alias("vs_hardcoded"),
        _as_map(
            components,
            "component",
            F.expr(f"struct({round_half_even('explained * 100')} AS explained_pct, dominant_pillar)"),
        ).alias("component_breakdown"),
    )
    chosen = sweep.where("chosen")
    found = F.struct(
        F.col("cluster_id"), F.col("archetype"), F.col(f"n_{card.plural}"), F.col(f"avg_{card.name}")
    )
    clustering = F.struct(
        F.lit("K-Means").alias("algorithm"),
        chosen.select("k").scalar().alias("optimal_k"),
        _as_map(sweep, "k", F.col("silhouette")).alias("silhouette_scores"),
        chosen.select("silhouette").scalar().alias("best_silhouette"),
        chosen.select("silhouette_kind").scalar().alias("silhouette_kind"),
        profiles.agg(F.sort_array(F.collect_list(found))).scalar().alias("archetypes"),
    )
    incomplete = F.expr(" OR ".join(f"{col(m.column)} IS NULL" for m in card.metrics))
    return entities.agg(F.count(F.lit(1)).alias("n"), F.count_if(incomplete).alias("incomplete")).select(
        F.lit(METHOD).alias("scoring_method"),
        pca.alias("pca"),
        clustering.alias("clustering"),
        F.lit(len(card.metrics)).alias("metrics"),
        F.lit(METHOD_NORMALISATION).alias("normalisation"),
        F.col("n").alias(card.plural),
        F.col("incomplete").alias(f"{card.plural}_left_out_of_components"),
        F.lit(fiscal_year).cast("int").alias("fiscal_year"),
    )
