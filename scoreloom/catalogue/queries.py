"""Every operator as a query over the star-schema tables.

Most queries score customers. Their entity table comes out of large joins and
is read more than once, so it is staged first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.expressions import col, named, round_half_even
from scoreloom.functions.literals import small_table
from scoreloom.operators import distribution, marts, state
from scoreloom.operators.audit import audit_fits, audit_profiles
from scoreloom.operators.cluster import (
    choose_k,
    euclidean_silhouette,
    squared_silhouette,
    weigh_points,
)
from scoreloom.operators.features import pillar_affinity, standardise
from scoreloom.operators.metadata import framework_record, method_record
from scoreloom.operators.normalise import (
    linear_inputs,
    normalise_01,
    normalise_100,
    universe_bounds,
)
from scoreloom.operators.profiles import (
    cluster_profiles,
    member_pages,
    number_clusters,
    profile_pages,
    with_archetype,
)
from scoreloom.operators.quantiles import describe
from scoreloom.operators.rank import bottom_n, group_percentiles, top_n
from scoreloom.operators.score import compare_weights, equal_weight_pillars, pillar_scores
from scoreloom.operators.silhouette_sample import overall_silhouette, silhouette_by_sample
from scoreloom.operators.sketches import (
    count_error,
    distinct_sketches,
    merged_counts,
    merged_sketches,
    quantile_sketches,
    quantiles_within,
    rank_error,
    sketched_quantiles,
)
from scoreloom.plans.archetypes import (
    Weights,
    derive_weights,
    enhance_scorecard,
    pillar_points,
    standardised_pillars,
    sweep_pillars,
)
from scoreloom.plans.scorecard import build_scorecard, score_entities
from scoreloom.plans.staging import stage, stage_once
from scoreloom.presets import CUSTOMER
from scoreloom.sources.customers import CUSTOMER_TABLES, read_customer_entities
from scoreloom.sources.registry import from_json, from_tables, registry_tables, to_json

Query = Callable[[SparkSession, str], DataFrame]

CARD = CUSTOMER
KEY = CARD.key
TOP_COLUMNS = [KEY, CARD.label, CARD.group, *CARD.all_scores, CARD.rating]
# Pillar weights of the comparison whose result SQL can check.
SCENARIO = {"fulfilment": 0.5, "commercial": 0.3, "credit": 0.2}
SCORING_DATE = "2024-01-01"
PAGE_ROWS = 25
LABELLINGS = (2, 3, 4)
SILHOUETTE_SAMPLE = 40
# Batches that the growing queries cut the universe into, by key.
BATCHES = 3


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    sources = [f"{folder}/{t}.parquet" for t in CUSTOMER_TABLES]
    return stage_once(spark, sources, lambda: read_customer_entities(spark, folder), "entities")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return score_entities(_entities(spark, folder), CARD)


def _of_scored(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(_scored(spark, folder))


def _of_entities(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(_entities(spark, folder))


def _rounded(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return df.selectExpr(
        *(named(round_half_even(col(c), digits), c) if c in columns else col(c) for c in df.columns)
    )


def load_profile(spark: SparkSession, folder: str) -> DataFrame:
    customers = spark.read.parquet(f"{folder}/customer.parquet").na.drop(subset=["c_custkey"])
    return marts.load_profile(customers.withColumnRenamed("c_mktsegment", CARD.group), CARD)


def universe_stats(spark: SparkSession, folder: str) -> DataFrame:
    return universe_bounds(read_customer_entities(spark, folder), linear_inputs(CARD.metrics))


def normalised_metrics(entities: DataFrame) -> DataFrame:
    return _rounded(normalise_01(entities, CARD, [KEY]), CARD.metric_columns, 6)


def scaled_metrics(entities: DataFrame) -> DataFrame:
    return _rounded(normalise_100(entities, CARD, [KEY]), [m.column for m in CARD.scaled], 4)


def standardised_metrics(entities: DataFrame) -> DataFrame:
    columns = CARD.metric_columns
    return _rounded(standardise(normalise_01(entities, CARD, [KEY]), columns, [KEY]), columns, 6)


def percentiles(scored: DataFrame) -> DataFrame:
    ranked = group_percentiles(scored.select(KEY, CARD.group, *CARD.all_scores), CARD.group, CARD.all_scores)
    return ranked.select(KEY, CARD.group, *(f"{s}_{CARD.group}_pct" for s in CARD.all_scores))


def metric_describe(entities: DataFrame) -> DataFrame:
    return describe(normalise_01(entities, CARD, []), CARD.metric_columns)


def weight_comparison(entities: DataFrame) -> DataFrame:
    return _compared(entities).select(
        KEY, CARD.label, f"{CARD.score}_hardcoded", f"{CARD.score}_pca", "score_delta"
    ).orderBy(F.desc_nulls_last("score_delta"), F.asc(KEY))


def derived_weight_comparison(entities: DataFrame) -> DataFrame:
    weights = derive_weights(entities, CARD, "skip").by_slug()
    return compare_weights(equal_weight_pillars(entities, CARD), CARD, weights).orderBy(
        F.desc_nulls_last("score_delta"), F.asc(KEY)
    )


def _country_profiles(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    compared = stage(_compared(entities), "compared")
    return compared, cluster_profiles(compared, CARD, "country", f"{CARD.score}_pca")


def country_profiles(entities: DataFrame) -> DataFrame:
    return _country_profiles(entities)[1]


def country_members(entities: DataFrame) -> DataFrame:
    compared, profiles = _country_profiles(entities)
    return profile_pages(profiles, member_pages(compared, CARD, "country", PAGE_ROWS), "country").select(
        "country", "page", CARD.plural, f"n_{CARD.plural}", "archetype"
    )


def _figures(table: Callable[[Weights], DataFrame], columns: list[str]) -> Query:
    """A table of the derived weights, its figures to six places."""
    return _of_entities(lambda e: _rounded(table(derive_weights(e, CARD, "skip")), columns, 6))


def _compared(entities: DataFrame) -> DataFrame:
    return compare_weights(equal_weight_pillars(entities, CARD), CARD, SCENARIO)


def numbered_countries(entities: DataFrame) -> DataFrame:
    score = f"{CARD.score}_pca"
    return number_clusters(stage(_compared(entities).select(KEY, "country", score), "compared"), "country", score)


def customer_archetypes(entities: DataFrame) -> DataFrame:
    compared, profiles = _country_profiles(entities)
    return with_archetype(compared.select(KEY, "country"), profiles, "country")


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").na.drop(subset=["embedding", "label"])
    return vectors.select(F.col("embedding").cast("array<double>").alias("features"), "label")


def silhouette_exact(spark: SparkSession, folder: str) -> DataFrame:
    points = weigh_points(_embeddings(spark, folder), ["features"], ["label"])
    return _rounded(euclidean_silhouette(points, ["label"]).select("silhouette"), ["silhouette"], 3)


def silhouette_squared(spark: SparkSession, folder: str) -> DataFrame:
    rows = _embeddings(spark, folder).withColumn("features", array_to_vector("features"))
    value = squared_silhouette(stage(rows, "embedding-rows"), "label")
    return _rounded(small_table(spark, [(value,)], "silhouette double"), ["silhouette"], 3)


def labelling_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Given labellings in place of fits: label modulo k; the k of the best rounded silhouette."""
    rows = _embeddings(spark, folder).withColumn("features", array_to_vector("features"))
    held = stage(rows.selectExpr("features", *(f"int(pmod(label, {k})) AS k{k}" for k in LABELLINGS)), "labellings")
    rounded, best = choose_k({k: squared_silhouette(held, f"k{k}") for k in LABELLINGS})
    return small_table(spark, [(k, s, k == best) for k, s in rounded.items()], "k int, silhouette double, chosen boolean")


def kmeans_sweep(entities: DataFrame) -> DataFrame:
    return sweep_pillars(standardised_pillars(equal_weight_pillars(entities, CARD), CARD), CARD).table


def cluster_scores(entities: DataFrame) -> DataFrame:
    return enhance_scorecard(entities, CARD, incomplete="skip").scores


def cluster_profile_pages(entities: DataFrame) -> DataFrame:
    done = enhance_scorecard(entities, CARD, incomplete="skip")
    return profile_pages(done.profiles, member_pages(done.scores, CARD, "cluster_id"), "cluster_id")


def kmeans_audit(entities: DataFrame) -> DataFrame:
    """Every fit of the sweep against the points it was made of."""
    pillars = standardised_pillars(equal_weight_pillars(entities, CARD), CARD)
    points = pillar_points(pillars, CARD)
    return audit_fits(points, sweep_pillars(pillars, CARD, points=points).fits)


def profile_audit(entities: DataFrame) -> DataFrame:
    done = enhance_scorecard(entities, CARD, incomplete="skip")
    return audit_profiles(done.scores, done.profiles, CARD)


def _batches(entities: DataFrame) -> list[DataFrame]:
    return [entities.where(F.pmod(KEY, F.lit(BATCHES)) == i) for i in range(BATCHES)]


def _grown(entities: DataFrame) -> state.State:
    """The state of the universe, from states of its batches under the bounds that the batches' moments give."""
    batches = _batches(entities)
    moments = state.merge_moments(reduce(DataFrame.unionByName, (state.metric_moments(b, CARD) for b in batches)))
    basis = stage(state.basis_of(moments), "basis")
    return reduce(state.merge_states, (state.batch_state(b, CARD, basis) for b in batches))


def merged_percentiles(entities: DataFrame) -> DataFrame:
    return state.state_percentiles(_grown(entities)).withColumnRenamed("group", CARD.group)


def merged_moments(entities: DataFrame) -> DataFrame:
    return state.state_figures(_grown(entities))


def moved_bounds(entities: DataFrame) -> DataFrame:
    """What the second and third batch move of the bounds that the first one set."""
    first, *later = _batches(entities)
    begun = state.batch_state(first, CARD)
    return state.moved_bounds(reduce(state.merge_states, (state.batch_state(b, CARD, begun.basis) for b in later), begun))


def registry_scorecard(entities: DataFrame) -> DataFrame:
    """The pillar scores under a registry that went through tables and JSON."""
    card = from_json(to_json(from_tables(**registry_tables(entities.sparkSession, CARD))))
    return pillar_scores(entities, card).select(KEY, *card.pillar_scores)


def silhouette_sampled(spark: SparkSession, folder: str) -> DataFrame:
    """By cluster, and last over all of them (label null)."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").selectExpr("CAST(embedding AS array<double>) AS features", "label", "vec_id")
    clusters = silhouette_by_sample(rows, "label", "vec_id", SILHOUETTE_SAMPLE)
    whole = overall_silhouette(clusters).selectExpr("CAST(NULL AS int) AS label", "*")
    return _rounded(clusters.unionByName(whole), ["silhouette", "standard_error"], 6)


def sketched_quartiles(entities: DataFrame) -> DataFrame:
    """Quartiles of every metric out of one sketch per country: is each within the stated error?"""
    columns = CARD.metric_columns
    parts = stage(quantile_sketches(entities, columns, ["country"]), "sketches")
    found = stage(sketched_quantiles(merged_sketches(parts), (0.25, 0.5, 0.75)), "sketched")
    return quantiles_within(entities, columns, found, rank_error()).select("metric", "prob", "n", "within")


def sketched_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct customers, days and priorities out of one sketch per month of orders, next to the exact count."""
    columns = ["o_custkey", "o_orderdate", "o_orderpriority"]
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("month", F.date_trunc("month", "o_orderdate"))
    merged = merged_counts(stage(distinct_sketches(orders, columns, ["month"]), "count-sketches"))
    # One distinct at a time: a row of several would copy every row for each.
    exact = reduce(DataFrame.union, (orders.agg(F.lit(c).alias("column"), F.countDistinct(c).alias("exact")) for c in columns))
    return merged.join(exact, "column").selectExpr("column", "parts", "rows", "exact", f"abs(distinct_values - exact) <= {count_error()!r}D * exact + 1 AS within")


def _as_text(record: DataFrame, columns: list[str]) -> DataFrame:
    return record.withColumns({c: F.to_json(c) for c in columns})


def framework_metadata(spark: SparkSession, folder: str) -> DataFrame:
    customers = spark.read.parquet(f"{folder}/customer.parquet").na.drop(subset=["c_custkey"])
    return _as_text(framework_record(customers, CARD, SCORING_DATE), ["pillars", "rating_bands"])


def ml_metadata(entities: DataFrame) -> DataFrame:
    done = enhance_scorecard(entities, CARD, incomplete="skip")
    record = method_record(
        entities, CARD, done.weights.components, done.weights.table, done.sweep.table, done.profiles
    )
    return _as_text(record, ["pca", "clustering"])


QUERIES: dict[str, Query] = {
    "entity_metrics": read_customer_entities,
    "load_profile": load_profile,
    "universe_stats": universe_stats,
    "normalised_metrics": _of_entities(normalised_metrics),
    "scaled_metrics": _of_entities(scaled_metrics),
    "pillar_scores": _of_entities(lambda e: pillar_scores(e, CARD).select(KEY, *CARD.pillar_scores)),
    "scorecard_master": _of_entities(lambda e: build_scorecard(e, CARD)),
    "group_percentiles": _of_scored(percentiles),
    "scores_long": _of_scored(lambda s: marts.scores_long(s, CARD)),
    "metric_detail": _of_entities(lambda e: marts.metric_detail(e, CARD)),
    "group_summary": _of_scored(lambda s: marts.group_summary(s, CARD)),
    "group_averages": _of_scored(lambda s: marts.group_averages(s, CARD)),
    "top_entities": _of_scored(lambda s: top_n(s.select(*TOP_COLUMNS), CARD.score, KEY)),
    "bottom_entities": _of_scored(lambda s: bottom_n(s.select(*TOP_COLUMNS), CARD.score, KEY)),
    "extremes_radar": _of_scored(lambda s: marts.extremes_radar(s, CARD)),
    "leaderboard": _of_scored(lambda s: marts.leaderboard(s, CARD)),
    "pillar_breakdown": _of_scored(lambda s: marts.pillar_breakdown(s, CARD)),
    "quadrants": _of_scored(lambda s: marts.quadrants(s, CARD)),
    "group_heatmap": _of_scored(lambda s: marts.group_heatmap(s, CARD)),
    "score_histogram": _of_scored(lambda s: marts.score_histogram(s, CARD)),
    "group_box_stats": _of_scored(lambda s: marts.group_box_stats(s, CARD)),
    "box_fences": _of_scored(lambda s: distribution.box_fences(s, CARD)),
    "box_points": _of_scored(lambda s: distribution.box_points(s, CARD, PAGE_ROWS)),
    "score_density": _of_scored(lambda s: distribution.score_density(s, CARD)),
    "chosen_bins": _of_scored(lambda s: distribution.binned_counts(s, [*CARD.all_scores, *CARD.metric_columns])),
    "metric_describe": _of_entities(metric_describe),
    "sketched_quartiles": _of_entities(sketched_quartiles),
    "sketched_counts": sketched_counts,
    "merged_percentiles": _of_entities(merged_percentiles),
    "merged_moments": _of_entities(merged_moments),
    "moved_bounds": _of_entities(moved_bounds),
    "registry_scorecard": _of_entities(registry_scorecard),
    "equal_weight_pillars": _of_entities(lambda e: equal_weight_pillars(e, CARD)),
    "weight_comparison": _of_entities(weight_comparison),
    "standardised_metrics": _of_entities(standardised_metrics),
    "country_profiles": _of_entities(country_profiles),
    "country_members": _of_entities(country_members),
    "pca_variance": _figures(lambda w: w.components, ["explained"]),
    "pca_loadings": _figures(lambda w: w.loadings, ["loading"]),
    "pca_affinity": _figures(lambda w: pillar_affinity(w.loadings), ["affinity"]),
    "pca_weights": _figures(lambda w: w.table, ["weight"]),
    "pca_weight_comparison": _of_entities(derived_weight_comparison),
    "numbered_countries": _of_entities(numbered_countries),
    "customer_archetypes": _of_entities(customer_archetypes),
    "labelling_choice": labelling_choice,
    "silhouette_exact": silhouette_exact,
    "silhouette_squared": silhouette_squared,
    "silhouette_sampled": silhouette_sampled,
    "kmeans_sweep": _of_entities(kmeans_sweep),
    "kmeans_audit": _of_entities(kmeans_audit),
    "profile_audit": _of_entities(profile_audit),
    "cluster_scores": _of_entities(cluster_scores),
    "cluster_profiles": _of_entities(cluster_profile_pages),
    "framework_metadata": framework_metadata,
    "ml_metadata": _of_entities(ml_metadata),
}
