"""Derived weights and archetypes on top of the equal-weight pillars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.config import Scorecard
from scoreloom.operators.cluster import RESTARTS, SQUARED, Sweep, sweep_clusters, weigh_points
from scoreloom.operators.features import (
    assemble,
    component_table,
    fit_components,
    loadings_table,
    standardise,
    variance_table,
    weight_table,
)
from scoreloom.operators.metadata import method_record
from scoreloom.operators.normalise import normalise_01
from scoreloom.operators.profiles import (
    cluster_profiles,
    member_pages,
    number_clusters,
    profile_pages,
    with_archetype,
)
from scoreloom.operators.score import compare_weights, equal_weight_pillars
from scoreloom.plans.staging import stage
from scoreloom.sources.writers import write_marts, write_record


@dataclass(frozen=True)
class Weights:
    components: DataFrame
    loadings: DataFrame
    table: DataFrame

    def by_slug(self) -> dict[str, float]:
        # One row per pillar of the registry.
        return {r["slug"]: r["weight"] for r in self.table.select("slug", "weight").collect()}


@dataclass(frozen=True)
class Enhanced:
    """Everything the enhancement yields."""

    scores: DataFrame
    weights: Weights
    sweep: Sweep
    profiles: DataFrame


def derive_weights(entities: DataFrame, card: Scorecard, incomplete: str = "error") -> Weights:
    """Pillar weights from the principal components of all metrics."""
    spark = entities.sparkSession
    model = fit_components(normalise_01(entities, card, []), card, incomplete=incomplete)
    loadings = loadings_table(model, card, spark)
    components = component_table(variance_table(model, spark), loadings)
    return Weights(components, loadings, weight_table(components, card))


def _z(score: str) -> str:
    return f"{score}_z"


def standardised_pillars(compared: DataFrame, card: Scorecard) -> DataFrame:
    """Scores plus standardised pillar scores, staged for repeated reading."""
    renamed = compared.select("*", *(F.col(s).alias(_z(s)) for s in card.pillar_scores))
    return stage(standardise(renamed, [_z(s) for s in card.pillar_scores], compared.columns), "pillars")


def pillar_points(pillars: DataFrame, card: Scorecard) -> DataFrame:
    """The distinct points of standardised pillar scores with their weights; incomplete rows are left out."""
    columns = [_z(s) for s in card.pillar_scores]
    return stage(assemble(weigh_points(pillars.na.drop(subset=columns), columns), columns).select("features", "weight"), "points")


def sweep_pillars(
    pillars: DataFrame, card: Scorecard, restarts: int = RESTARTS, silhouette: str = SQUARED, points: DataFrame | None = None
) -> Sweep:
    """The k sweep over standardised pillar scores; incomplete rows are left out.

    ``points`` are those of ``pillar_points``, if the caller has them already.
    """
    columns = [_z(s) for s in card.pillar_scores]
    rows = assemble(pillars.na.drop(subset=columns), columns).select("features")
    return sweep_clusters(points if points is not None else pillar_points(pillars, card), rows, restarts=restarts, silhouette=silhouette)


def assign_clusters(pillars: DataFrame, card: Scorecard, sweep: Sweep) -> DataFrame:
    """Add ``cluster_id``, numbered by ascending mean composite; null for incomplete rows."""
    columns = [_z(s) for s in card.pillar_scores]
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    model = sweep.best.model.setFeaturesCol("features").setPredictionCol("_raw")
    labelled = stage(
        model.transform(assemble(pillars, columns, incomplete="keep"))
        .withColumn("_raw", F.when(complete, F.col("_raw")))
        .drop("features", *columns),
        "labelled",
    )
    return number_clusters(labelled, "_raw", f"{card.score}_pca").drop("_raw")


def _require_rows(entities: DataFrame, card: Scorecard, incomplete: str) -> None:
    usable = entities.na.drop(subset=card.metric_columns) if incomplete == "skip" else entities
    if usable.isEmpty():
        lack = "complete row" if incomplete == "skip" and not entities.isEmpty() else "row"
        raise ValueError(f"scorecard {card.name!r} has no {lack} to learn weights and clusters from")


def enhance_scorecard(
    entities: DataFrame,
    card: Scorecard,
    incomplete: str = "error",
    restarts: int = RESTARTS,
    silhouette: str = SQUARED,
) -> Enhanced:
    """Derived weights, both composites, clusters and archetypes.

    Components need complete rows. With ``incomplete="error"`` a null metric
    raises; with ``"skip"`` such rows are left out of the fits, yet keep their
    row in the result. ``entities`` is read several times, so stage it first
    when it is the outcome of joins or aggregates. No rows, or none that may
    enter the components, raise.
    """
    _require_rows(entities, card, incomplete)
    weights = derive_weights(entities, card, incomplete)
    compared = compare_weights(equal_weight_pillars(entities, card), card, weights.by_slug())
    pillars = standardised_pillars(compared, card)
    sweep = sweep_pillars(pillars, card, restarts, silhouette)
    assigned = assign_clusters(pillars, card, sweep)
    profiles = stage(cluster_profiles(assigned, card, "cluster_id", f"{card.score}_pca"), "profiles")
    scores = with_archetype(assigned, profiles, "cluster_id").select(*compared.columns, "cluster_id", "archetype")
    return Enhanced(scores, weights, sweep, profiles)


def run_enhancement(
    entities: DataFrame,
    card: Scorecard,
    folder: str,
    fmt: str = "csv",
    incomplete: str = "error",
    fiscal_year: int | None = None,
    restarts: int = RESTARTS,
    silhouette: str = SQUARED,
) -> Enhanced:
    """Run the enhancement and write its tables and record under ``folder``.

    ``silhouette`` is the kind that chooses k and stands in the record: "euclidean"
    takes every distance, "squared_euclidean" is one linear pass.
    """
    held = stage(entities, "entities")
    done = enhance_scorecard(held, card, incomplete, restarts, silhouette)
    scores = stage(done.scores, "enhanced")
    pages = profile_pages(done.profiles, member_pages(scores, card, "cluster_id"), "cluster_id")
    write_marts(
        {
            f"{card.name}_ml_scores": scores,
            "pca_explained_variance": done.weights.components.drop("explained"),
            "cluster_profiles": pages.orderBy("cluster_id", "page"),
        },
        folder,
        fmt,
    )
    record = method_record(
        held, card, done.weights.components, done.weights.table, done.sweep.table, done.profiles, fiscal_year
    )
    write_record(record, f"{folder.rstrip('/')}/ml_methodology")
    return Enhanced(scores, done.weights, done.sweep, done.profiles)
