"""Pillar and composite scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from scoreloom.config import FLAG, PENALTY, Metric, Scorecard
from scoreloom.functions.expressions import (
    band,
    clip,
    col,
    named,
    num,
    penalty,
    rating,
    round_half_even,
    row_mean,
)
from scoreloom.operators.normalise import (
    Range,
    find_bounds,
    min_max_100,
    normalise_01,
    scaling_input,
)


def _term(metric: Metric, bounds: Mapping[str, Range]) -> str:
    """A metric's weighted contribution, with its sign."""
    if metric.kind == PENALTY:
        return f"- {penalty(col(metric.column), metric.cap, metric.points)} * {num(metric.weight)}"
    if metric.kind == FLAG:
        return f"+ double({col(metric.column)}) * 100D * {num(metric.weight)}"
    scaled = min_max_100(scaling_input(metric), bounds[metric.column], metric.lower_is_better)
    return f"+ ({scaled}) * {num(metric.weight)}"


def pillar_expression(card: Scorecard, slug: str, bounds: Mapping[str, Range]) -> str:
    """Weighted sum in registry order. Any null input gives null."""
    return " ".join(_term(m, bounds) for m in card.of_pillar(slug)).removeprefix("+ ")


def pillar_scores(df: DataFrame, card: Scorecard) -> DataFrame:
    """``df`` plus one rounded 0..100 score per pillar: a projection, no shuffle."""
    return pillar_scores_within(df, card, find_bounds(df, {m.column: scaling_input(m) for m in card.scaled}))


def pillar_scores_within(df: DataFrame, card: Scorecard, bounds: Mapping[str, Range]) -> DataFrame:
    """The same under given bounds of the scaled metrics."""
    kept = [col(c) for c in df.columns]
    raw = df.selectExpr(
        *kept, *(named(pillar_expression(card, p.slug, bounds), p.score) for p in card.pillars)
    )
    return raw.selectExpr(
        *kept, *(named(round_half_even(clip(col(s), 0.0, 100.0)), s) for s in card.pillar_scores)
    )


def weighted(card: Scorecard, weights: Mapping[str, float]) -> str:
    """Weighted sum of the pillar scores, rounded."""
    return round_half_even(" + ".join(f"{col(p.score)} * {num(weights[p.slug])}" for p in card.pillars))


def composite(df: DataFrame, card: Scorecard) -> DataFrame:
    """Add the composite of the rounded pillars and its letter."""
    return df.selectExpr("*", named(weighted(card, card.weights), card.score)).selectExpr(
        "*", named(rating(col(card.score)), card.rating)
    )


def bands(df: DataFrame, card: Scorecard) -> DataFrame:
    """Add the band of the composite and of every pillar."""
    names = {card.score: card.band, **{p.score: f"{p.slug}_band" for p in card.pillars}}
    return df.selectExpr("*", *(named(band(col(score)), name) for score, name in names.items()))


def equal_weight_pillars(df: DataFrame, card: Scorecard) -> DataFrame:
    """Identity columns plus pillar scores as plain means of the 0..1 metrics.

    Nulls are skipped here, unlike in :func:`pillar_scores`.
    """
    keep = [c for c in (*card.id_columns, card.size) if c]

    def score(slug: str) -> str:
        return round_half_even(f"{row_mean([col(m.column) for m in card.of_pillar(slug)])} * 100D")

    return normalise_01(df, card, keep).selectExpr(
        *map(col, keep), *(named(score(p.slug), p.score) for p in card.pillars)
    )


def compare_weights(pillars: DataFrame, card: Scorecard, derived: Mapping[str, float]) -> DataFrame:
    """Add the composite under fixed and under derived weights, and their gap."""
    fixed, own = f"{card.score}_hardcoded", f"{card.score}_pca"
    both = pillars.selectExpr("*", named(weighted(card, card.weights), fixed), named(weighted(card, derived), own))
    return both.selectExpr("*", named(round_half_even(f"{col(own)} - {col(fixed)}"), "score_delta"))
