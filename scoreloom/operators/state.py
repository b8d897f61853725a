"""The state of a scorecard that grows by batches.

A score needs the whole universe: the bounds of every metric, and for percentiles
how often each score occurs in each group. Both merge, so a batch leaves

- ``metrics``: per metric the number of values, bounds, mean and squared
  deviations, under its linear and its transformed form;
- ``counts``: per group and measure how often each rounded score occurs;
- ``basis``: the bounds that the scores were made with.

States merge without the rows they came from, as long as they share a basis. A
batch that moves a bound says which: then all scores change, and ``rebase`` names
the bounds for the pass over all rows that this takes. All three tables are as
long as the registry, or as groups times 1001 scores.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.config import Scorecard
from scoreloom.functions.expressions import col, named, round_half_even, text
from scoreloom.functions.literals import small_table
from scoreloom.operators.normalise import Range, linear_inputs, scaling_input
from scoreloom.operators.score import bands, composite, pillar_scores_within
from scoreloom.plans.staging import stage

_BASIS = "metric string, lo double, hi double"
_TABLES = ("metrics", "counts", "basis")


@dataclass(frozen=True)
class State:
    """What a universe, or a batch of it, leaves behind."""

    metrics: DataFrame  # metric, form, n, lo, hi, mean, squares
    counts: DataFrame  # group, measure, score, ties
    basis: DataFrame  # metric, lo, hi

    def bounds(self) -> dict[str, Range]:
        """The basis as a mapping; as long as the registry."""
        return {r["metric"]: (r["lo"], r["hi"]) for r in self.basis.collect()}


def metric_moments(entities: DataFrame, card: Scorecard) -> DataFrame:
    """``metric, form, n, lo, hi, mean, squares`` of every metric: one aggregate over the rows.

    ``form`` is ``linear``, or ``scaled`` with the metric's transform applied; a
    metric without values has n 0 and nulls.
    """
    inputs = {(m, "linear"): x for m, x in linear_inputs(card.metrics).items()}
    inputs |= {(m.column, "scaled"): scaling_input(m) for m in card.scaled}
    figures = [
        f"struct({text(m)} AS metric, {text(form)} AS form, count({x}) AS n, min({x}) AS lo, max({x}) AS hi, "
        f"avg({x}) AS mean, var_pop({x}) * count({x}) AS squares) AS {col(f'{m}_{form}')}"
        for (m, form), x in inputs.items()
    ]
    cells = ", ".join(col(f"{m}_{form}") for m, form in inputs)
    return entities.selectExpr(*figures).selectExpr(f"inline(array({cells}))")


def merge_moments(moments: DataFrame) -> DataFrame:
    """Moments of parts (rows repeated by metric and form) as those of the whole.

    The squared deviations add up around the common mean, so no digit is lost to
    the size of the values.
    """
    totals = Window.partitionBy("metric", "form")
    n = F.sum("n").over(totals)
    mean = F.sum(F.col("n") * F.col("mean")).over(totals) / n
    gap = F.col("n") * F.pow(F.col("mean") - F.col("common"), 2)
    return (
        moments.withColumn("common", F.when(n > 0, mean))
        .groupBy("metric", "form")
        .agg(
            F.sum("n").alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.max("common").alias("mean"),
            F.sum(F.col("squares") + gap).alias("squares"),
        )
    )


def basis_of(metrics: DataFrame) -> DataFrame:
    """``metric, lo, hi``: the bounds that scores of this universe need."""
    return metrics.where("form = 'scaled'").select("metric", "lo", "hi")


def score_counts(scored: DataFrame, card: Scorecard) -> DataFrame:
    """``group, measure, score, ties`` of every score; rows without group or score do not count."""
    return (
        scored.where(F.col(card.group).isNotNull())
        .unpivot([F.col(card.group).cast("string").alias("group")], card.all_scores, "measure", "score")
        .where("score IS NOT NULL")
        .groupBy("group", "measure", "score")
        .agg(F.count(F.lit(1)).alias("ties"))
    )


def score_batch(entities: DataFrame, card: Scorecard, bounds: Mapping[str, Range]) -> DataFrame:
    """``entities`` with scores, rating and bands under given bounds: a projection.

    A value outside its bounds scales below 0 or above 100; pillars are cut at both ends.
    """
    return bands(composite(pillar_scores_within(entities, card, bounds), card), card)


def batch_state(entities: DataFrame, card: Scorecard, basis: DataFrame | None = None) -> State:
    """The state of one batch, its scores made with ``basis`` or else with the batch's own bounds.

    The tables are staged: two passes over the batch, and none later.
    """
    metrics = stage(metric_moments(entities, card), "state-metrics")
    basis = stage(basis if basis is not None else basis_of(metrics), "state-basis")
    state = State(metrics, metrics, basis)
    counts = stage(score_counts(score_batch(entities, card, state.bounds()), card), "state-counts")
    return State(metrics, counts, basis)


def merge_states(first: State, second: State) -> State:
    """The state of both batches, from their states alone; they must share a basis."""
    a, b = first.bounds(), second.bounds()
    if a != b:
        other = sorted(m for m in a.keys() | b.keys() if a.get(m) != b.get(m))
        raise ValueError(f"scores made with other bounds of {', '.join(other)} do not add up")
    counts = first.counts.unionByName(second.counts).groupBy("group", "measure", "score").agg(F.sum("ties").alias("ties"))
    return State(stage(merge_moments(first.metrics.unionByName(second.metrics)), "state-metrics"), stage(counts, "state-counts"), first.basis)


def moved_bounds(state: State) -> DataFrame:
    """``metric, lo, hi, new_lo, new_hi`` of the metrics whose bounds are no longer those of the basis.

    No rows: the scores and percentiles of the state hold for its whole universe.
    """
    now = basis_of(state.metrics).toDF("metric", "new_lo", "new_hi")
    return state.basis.join(now, "metric").where("NOT (lo <=> new_lo AND hi <=> new_hi)")


def rebase(state: State, entities: DataFrame, card: Scorecard) -> State:
    """The state under its own bounds: ``entities``, all rows of its universe, are scored again."""
    basis = stage(basis_of(state.metrics), "state-basis")
    fresh = State(state.metrics, state.counts, basis)
    counts = stage(score_counts(score_batch(entities, card, fresh.bounds()), card), "state-counts")
    return State(state.metrics, counts, basis)


def state_percentiles(state: State) -> DataFrame:
    """``group, measure, score, pct``: average rank over group size, from the counts alone."""
    members = "PARTITION BY `group`, measure"
    so_far = f"sum(ties) OVER ({members} ORDER BY score ROWS UNBOUNDED PRECEDING)"
    share = f"({so_far} - (ties - 1) / 2D) / sum(ties) OVER ({members}) * 100D"
    return state.counts.selectExpr("`group`", "measure", "score", named(round_half_even(share), "pct"))


def state_figures(state: State, digits: int = 6) -> DataFrame:
    """``metric, form, n, lo, hi, mean, dev``: the moments as figures, rounded; dev is the population's."""
    figures = {"lo": "lo", "hi": "hi", "mean": "mean", "dev": "sqrt(squares / n)"}
    return state.metrics.selectExpr("metric", "form", "n", *(named(round_half_even(x, digits), n) for n, x in figures.items()))


def percentiles_within(scored: DataFrame, card: Scorecard, state: State) -> DataFrame:
    """``scored`` rows, such as those of one batch, with their percentiles in the state's universe."""
    table = stage(state_percentiles(state), "percentiles")
    out = scored
    for score in card.all_scores:
        one = table.where(f"measure = {text(score)}").selectExpr("`group` AS __group", named("score", score), named("pct", f"{score}_{card.group}_pct"))
        out = out.join(one, (out[card.group].cast("string") == one["__group"]) & (out[score] == one[score]), "left").drop(one[score], one["__group"])
    return out.select(*scored.columns, *(f"{s}_{card.group}_pct" for s in card.all_scores))


def save_state(state: State, path: str) -> None:
    """Write the three tables under a new ``path``; one that is there already raises."""
    for name in _TABLES:
        getattr(state, name).coalesce(1).write.mode("error").parquet(f"{path.rstrip('/')}/{name}")


def load_state(spark: SparkSession, path: str) -> State:
    return State(*(spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in _TABLES))


def given_basis(spark: SparkSession, bounds: Mapping[str, Range]) -> DataFrame:
    """Bounds that are known beforehand as a basis, so that the first batch need not set them."""
    return small_table(spark, [(m, *b) for m, b in bounds.items()], _BASIS)
