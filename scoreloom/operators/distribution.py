"""How scores are distributed: bins chosen from the data, box fences and points, a smooth density.

Scores are rounded to 0.1 in 0..100, so a group has at most 1001 different ones.
Everything here counts them first (combined map-side) and works on the counts;
no task holds the rows of a group.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.config import Scorecard
from scoreloom.functions.expressions import col, named, num, round_half_even, text
from scoreloom.functions.literals import small_table
from scoreloom.operators.normalise import Range, find_bounds
from scoreloom.operators.rank import with_group_position
from scoreloom.plans.staging import stage

MOST_BINS = 10
# Steps between bin edges: these times a power of ten.
STEPS = (1, 2, 5)
# How far from a quartile a fence stands, in interquartile ranges.
FENCE = 1.5
PAGE_ROWS = 1000
# Grid of the density, and the rule of its bandwidth: FACTOR * deviation * n ** POWER.
GRID = 1.0
FACTOR, POWER = 1.06, -0.2


# --- Bins -------------------------------------------------------------------


def bin_step(lo: float, hi: float, most: int = MOST_BINS) -> float:
    """The least step of 1, 2 or 5 times a power of ten that needs at most ``most`` bins.

    Bins begin at multiples of the step and hold their lower edge; so the bin of
    ``hi`` counts in full. A single value has a bin of width 1 around it.
    """
    if most < 2:
        raise ValueError("at least two bins")
    if not (math.isfinite(lo) and math.isfinite(hi)):
        raise ValueError(f"no bins from {lo} to {hi}")
    if lo == hi:
        return 1.0
    power = math.floor(math.log10((hi - lo) / most)) - 1
    while True:
        for factor in STEPS:
            # Powers of ten below one are inexact; their reciprocals are not.
            step = factor * 10.0**power if power >= 0 else factor / 10.0**-power
            if math.floor(hi / step) - math.floor(lo / step) < most:
                return step
        power += 1


def _binned(measure: str, bounds: Range, most: int) -> str:
    """SQL: the measure's name, step and bin of its value."""
    step = num(bin_step(*bounds, most))
    return f"struct({text(measure)} AS measure, {step} AS step, bigint(floor(double({col(measure)}) / {step})) AS bin)"


def binned_counts(df: DataFrame, measures: Sequence[str], most: int = MOST_BINS) -> DataFrame:
    """``measure, bin, low, high, entities`` of every measure, its edges chosen from its bounds.

    ``bin`` counts from 0 at the least value; bins between without a row count 0.
    Nulls and NaN do not count, a measure without values has no bins. Infinite
    values raise. Two passes: one for the bounds of all measures, one that counts.
    """
    finite = df.selectExpr(*(named(f"nullif(double({col(m)}), double('NaN'))", m) for m in measures))
    bounds: Mapping[str, Range] = {m: b for m, b in find_bounds(finite, {m: col(m) for m in measures}).items() if b[0] is not None}
    spark = df.sparkSession
    if not bounds:
        return small_table(spark, [], "measure string, bin long, low double, high double, entities long")
    cells = ", ".join(_binned(m, b, most) for m, b in bounds.items())
    counts = (
        finite.selectExpr(f"inline(array({cells}))")
        .where("bin IS NOT NULL")
        .groupBy("measure", "step", "bin")
        .agg(F.count(F.lit(1)).alias("entities"))
    )
    # At most ``most`` edges a measure: as long as the registry.
    edges = [
        (m, step, first + i, i)
        for m, (lo, hi) in bounds.items()
        for step in (bin_step(lo, hi, most),)
        for first in (math.floor(lo / step),)
        for i in range(math.floor(hi / step) - first + 1)
    ]
    every = small_table(spark, edges, "measure string, step double, bin long, place long")
    return F.broadcast(every).join(counts, ["measure", "step", "bin"], "left").selectExpr(
        "measure", "place AS bin", "bin * step AS low", "(bin + 1) * step AS high", "coalesce(entities, 0L) AS entities"
    )


# --- Boxes ------------------------------------------------------------------


def _counted(scored: DataFrame, group: str, score: str) -> DataFrame:
    """``group, score, ties``: how often each score occurs in its group."""
    return (
        scored.where(F.col(group).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(group).alias("grp"), F.col(score).alias("score"))
        .agg(F.count(F.lit(1)).alias("ties"))
    )


def box_fences(scored: DataFrame, card: Scorecard) -> DataFrame:
    """Quartiles, fences, whiskers and the number of outliers of the composite per group.

    Fences stand ``FENCE`` interquartile ranges outside the quartiles; a whisker
    ends at the last score that is not outside its fence. Figures between two
    scores have three decimals. Rows without group or score are left out.
    """
    counts = stage(_counted(scored, card.group, card.score), "score-counts")
    quartiles = counts.groupBy("grp").agg(
        F.sum("ties").alias("entities"), *(F.percentile("score", p, F.col("ties")).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
    )
    three = [named(round_half_even(q, 3), q) for q in ("q25", "q50", "q75")]
    fenced = quartiles.selectExpr("grp", "entities", *three).selectExpr(
        "*",
        named(round_half_even(f"q25 - {num(FENCE)} * (q75 - q25)", 4), "low_fence"),
        named(round_half_even(f"q75 + {num(FENCE)} * (q75 - q25)", 4), "high_fence"),
    )
    inside = F.col("score").between(F.col("low_fence"), F.col("high_fence"))
    whiskers = (
        counts.join(fenced.selectExpr("grp", "low_fence", "high_fence"), "grp")
        .groupBy("grp")
        .agg(
            F.min(F.when(inside, F.col("score"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("score"))).alias("high_whisker"),
            F.coalesce(F.sum(F.when(~inside, F.col("ties"))), F.lit(0)).cast("long").alias("outliers"),
        )
    )
    return fenced.join(whiskers, "grp").withColumnRenamed("grp", card.group)


def box_points(scored: DataFrame, card: Scorecard, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Every entity as a point beside its group's box, in pages: ``page, position, outlier``.

    Points go from the lowest score up, ties by key; a page has ``page_rows`` of
    one group. ``outlier`` says that the score lies outside its group's fences.
    The fences, one row a group, are staged, so that Spark knows their size.
    """
    fences = stage(box_fences(scored, card).select(card.group, "low_fence", "high_fence"), "fences")
    rows = scored.where(F.col(card.group).isNotNull() & F.col(card.score).isNotNull()).select(card.key, card.label, card.group, card.score)
    placed = with_group_position(rows, card.group, [F.asc(card.score), F.asc(card.key)])
    score = col(card.score)
    return placed.join(fences, card.group).selectExpr(
        *map(col, (card.group, card.key, card.label, card.score)),
        f"int((position - 1) div {page_rows}) AS page",
        "position",
        f"{score} < low_fence OR {score} > high_fence AS outlier",
    )


# --- Density ----------------------------------------------------------------


def score_density(scored: DataFrame, card: Scorecard, grid: float = GRID, digits: int = 9) -> DataFrame:
    """A Gaussian density of the composite, per group and over all: ``group, whole, bandwidth, point, density``.

    The group of all rows is null; rows without a group count in it alone. The
    bandwidth is ``FACTOR`` times the sample deviation times the fifth root of
    1 / n, both from the moments of the counts. Each of at most 1001 counts a group
    meets each point of the grid over 0..100. A group of one score, or of one row, has no width and
    no density.
    """
    own = scored.where(F.col(card.score).isNotNull()).groupBy(F.col(card.group).alias("grp"), F.col(card.score).alias("score")).agg(F.count(F.lit(1)).alias("ties"))
    counted = stage(own, "score-counts")
    whole = counted.groupBy("score").agg(F.sum("ties").alias("ties")).selectExpr("true AS whole", "CAST(NULL AS string) AS grp", "score", "ties")
    both = whole.union(counted.where("grp IS NOT NULL").selectExpr("false", "CAST(grp AS string)", "score", "ties"))
    # Tenths are whole numbers, so the moments do not depend on the order of the rows.
    tenths = "bigint(rint(score * 10))"
    moments = (
        both.groupBy("whole", "grp")
        .agg(F.sum("ties").alias("n"), F.expr(f"sum(ties * {tenths})").alias("s"), F.expr(f"sum(ties * {tenths} * {tenths})").alias("q"))
        .where("n > 1 AND n * q > s * s")
        .selectExpr("whole", "grp", "n", f"{num(FACTOR)} * sqrt((double(q) - double(s) * double(s) / n) / (n - 1)) / 10D * power(n, {num(POWER)}) AS bandwidth")
    )
    points = int(100 / grid)
    placed = both.selectExpr("*", f"explode(transform(sequence(0, {points}), i -> i * {num(grid)})) AS point")
    same = (F.col("b.whole") == F.col("m.whole")) & F.col("b.grp").eqNullSafe(F.col("m.grp"))
    bell = "sum(ties * exp(-0.5D * power((point - score) / bandwidth, 2))) / (max(n) * max(bandwidth) * sqrt(2D * pi()))"
    # Moments are as many as groups; staged, they are broadcast while that is few.
    return (
        placed.alias("b").join(stage(moments, "moments").alias("m"), same)
        .groupBy("b.whole", "b.grp", "point")
        .agg(F.max("bandwidth").alias("bandwidth"), F.expr(bell).alias("density"))
        .selectExpr(
            named("grp", card.group), "whole", named(round_half_even("bandwidth", digits), "bandwidth"), "point", named(round_half_even("density", digits), "density")
        )
    )
