"""Tables shaped for reporting, all derived from the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.config import BAND_COLOURS, Scorecard
from scoreloom.functions.expressions import (
    col,
    lookup,
    mean_of_rounded,
    named,
    round_half_even,
    score_text,
)
from scoreloom.functions.literals import small_table
from scoreloom.operators.normalise import find_bounds, linear_inputs
from scoreloom.operators.rank import bottom_n, top_n, with_position


def _melt_pillars(df: DataFrame, card: Scorecard, ids: list[str]) -> DataFrame:
    """One row per entity and pillar, in one pass over the rows."""
    labels = {p.score: p.label for p in card.pillars}
    long = df.unpivot(ids, card.pillar_scores, "pillar", "pillar_score")
    return long.withColumn("pillar", F.expr(lookup("pillar", labels)))


def scores_long(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Pillar scores in long form next to the composite, its letter and band."""
    ids = [*card.id_columns, *([card.size] if card.size else []), card.score, card.rating, card.band]
    return _melt_pillars(scored, card, ids).select(*ids, "pillar_score", "pillar")


def metric_detail(entities: DataFrame, card: Scorecard) -> DataFrame:
    """One row per entity and scaled metric: raw value, linear 0..100 score, direction.

    The registry, bounds included, becomes a table of one row per metric. The
    entities are melted in a single pass and meet it there.
    """
    inputs = linear_inputs(card.scaled)
    bounds = find_bounds(entities, inputs)
    facts = small_table(
        entities.sparkSession,
        [
            (m.column, card.pillar_label(m.pillar), m.label, m.lower_is_better, *bounds[m.column])
            for m in card.scaled
        ],
        "column string, pillar string, metric_name string, lower_is_better boolean, lo double, hi double",
    )
    long = entities.selectExpr(
        *map(col, card.id_columns), *(named(x, c) for c, x in inputs.items())
    ).unpivot(card.id_columns, list(inputs), "column", "raw_value")
    scaled = "(raw_value - lo) / (hi - lo) * 100D"
    directed = f"CASE WHEN lo = hi THEN 50D WHEN lower_is_better THEN 100D - {scaled} ELSE {scaled} END"
    return long.join(F.broadcast(facts), "column").selectExpr(
        *map(col, card.id_columns),
        "pillar",
        "metric_name",
        "raw_value",
        named(round_half_even(directed), "normalised_score"),
        "lower_is_better",
    )


def _averages(card: Scorecard, names: dict[str, str]) -> list:
    return [F.expr(named(round_half_even(mean_of_rounded(col(s))), n)) for s, n in names.items()]


def group_summary(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Per group: entity count, mean scores, the best entity and its score.

    Ties for the best go to the smallest key. Rows without a group are left out.
    """
    means = {card.score: f"avg_{card.name}", **{p.score: f"avg_{p.slug}" for p in card.pillars}}
    top = f"top_{card.name}"
    ours = scored.where(F.col(card.group).isNotNull())
    # Numbers only, so every step is a hash aggregate: sums and the highest score first,
    summary = ours.groupBy(card.group).agg(
        F.count(card.key).alias(f"{card.label}_count"), *_averages(card, means), F.max(card.score).alias(top)
    )
    # then, among the few rows with that score, the smallest key; its row has the label.
    best = ours.select(card.group, F.col(card.score).alias(top), card.key, card.label).join(summary.select(card.group, top), [card.group, top])
    first = best.groupBy(card.group).agg(F.min(card.key).alias(card.key))
    labels = best.join(first, [card.group, card.key]).select(card.group, F.col(card.label).alias(f"top_{card.label}")).dropDuplicates([card.group])
    return summary.join(labels, card.group, "left").select(*summary.columns[:-1], f"top_{card.label}", top)


def group_averages(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Mean of every score per group, rounded."""
    return (
        scored.where(F.col(card.group).isNotNull())
        .groupBy(card.group)
        .agg(*_averages(card, {s: s for s in card.all_scores}))
    )


def leaderboard(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Every entity with its position (1 is best), band colour and score label; the lowest first, as on a chart."""
    rows = scored.select(
        card.key,
        card.label,
        card.group,
        card.score,
        card.band,
        F.expr(named(lookup(col(card.band), BAND_COLOURS), "colour")),
        F.expr(named(score_text(col(card.score), col(card.rating)), "score_label")),
    )
    return with_position(rows, [F.desc_nulls_last(card.score), F.asc(card.key)]).orderBy(F.desc("position"))


def pillar_breakdown(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Pillar scores in long form with chart colours, best composite first."""
    colours = {p.label: p.colour for p in card.pillars}
    return (
        _melt_pillars(scored, card, [card.key, card.label, card.score])
        .withColumn("colour", F.expr(lookup("pillar", colours)))
        .orderBy(F.desc_nulls_last(card.score), F.asc(card.key), F.asc("pillar"))
    )


def quadrants(scored: DataFrame, card: Scorecard, split: float = 50.0) -> DataFrame:
    """First against second pillar, sized by the third, with the quadrant's name."""
    across, up, size = card.pillars
    right, above = F.col(across.score) >= split, F.col(up.score) >= split
    return scored.select(
        card.key,
        card.label,
        card.group,
        F.col(across.score).alias("x"),
        F.col(up.score).alias("y"),
        F.col(size.score).alias("bubble"),
        F.col(card.score),
        F.when(right & above, f"{across.label} and {up.label}")
        .when(right & ~above, f"{across.label} only")
        .when(~right & above, f"{up.label} only")
        .when(~right & ~above, "Neither")
        .alias("quadrant"),
    )


def group_heatmap(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Group by pillar matrix of mean scores, best composite first."""
    names = {p.score: p.label for p in card.pillars} | {card.score: card.composite_label}
    return (
        group_averages(scored, card)
        .withColumnsRenamed(names)
        .orderBy(F.desc_nulls_last(card.composite_label), F.asc(card.group))
    )


def extremes_radar(scored: DataFrame, card: Scorecard, n: int = 3) -> DataFrame:
    """The four scores of the best and the worst ``n`` entities, in long form."""
    names = {p.score: f"{p.label} Score" for p in card.pillars} | {
        card.score: f"{card.composite_label} Score"
    }
    columns = [card.key, card.label, *card.all_scores]
    best = top_n(scored.select(*columns), card.score, card.key, n)
    worst = bottom_n(scored.select(*columns), card.score, card.key, n)
    ends = best.withColumn("side", F.lit("top")).unionByName(worst.withColumn("side", F.lit("bottom")))
    return ends.unpivot(["side", card.key, card.label], card.all_scores, "category", "score").withColumn(
        "category", F.expr(lookup("category", names))
    )


def score_histogram(scored: DataFrame, card: Scorecard, width: float = 10.0, bins: int = 10) -> DataFrame:
    """Counts per fixed-width bin of the composite; the last bin includes its end."""
    score = F.col(card.score)
    number = F.least(F.floor(score / F.lit(width)), F.lit(bins - 1)).cast("long")
    return (
        scored.where(score.isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("entities"))
        .select(
            "bin",
            (F.col("bin") * F.lit(width)).alias("low"),
            ((F.col("bin") + 1) * F.lit(width)).alias("high"),
            "entities",
        )
    )


def group_box_stats(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Five-number summary of the composite per group.

    The exact percentile keeps one counter per distinct score: at most 1001 for
    scores rounded to 0.1, however large the group.
    """
    score = F.col(card.score)
    quartiles = F.percentile(score, [0.25, 0.5, 0.75])
    return (
        scored.where(F.col(card.group).isNotNull())
        .groupBy(card.group)
        .agg(
            F.count(score).alias("entities"),
            F.min(score).alias("low"),
            quartiles.alias("q"),
            F.max(score).alias("high"),
        )
        .select(
            card.group,
            "entities",
            "low",
            # Points between two scores a tenth apart have three decimals at most.
            *(F.expr(named(round_half_even(f"q[{i}]", 3), n)) for i, n in enumerate(("q25", "q50", "q75"))),
            "high",
        )
    )


def load_profile(entities: DataFrame, card: Scorecard) -> DataFrame:
    """Row count and number of distinct groups."""
    return entities.agg(
        F.count(F.lit(1)).alias("entities"),
        F.countDistinct(card.group).alias("groups"),
    )
