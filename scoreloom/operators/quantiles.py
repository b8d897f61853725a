"""Exact quantiles of many columns without sorting them whole.

The built-in exact percentile keeps every distinct value of a column in one
buffer. Here each wanted order statistic lies between two values of its column,
at first the least and the greatest. Approximate quantiles cut that bracket,
counts prove which piece holds what was asked, and so on until few rows lie
strictly inside; only those are ranked. A cut in the wrong place costs a round,
never the result. Each round takes two passes, and leaves about one row in
1,600, so 10^12 rows need four.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from scoreloom.functions.expressions import col, named, num, round_half_even, text
from scoreloom.functions.literals import small_table

# Of the approximate quantiles: 1/error in rank, and how far from the wanted
# rank the cuts go, as a share of the rows inside.
ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY
# Rows strictly inside a bracket that are ranked as they are.
KEEP = 1_000


@dataclass(frozen=True)
class _End:
    """A value of the column: how many rows are less, and how many not greater."""

    value: float
    less: int
    upto: int


@dataclass(frozen=True)
class _Bracket:
    metric: str
    prob: float
    rank: int  # zero-based order statistic at or before the wanted point
    last: int  # the next one, if there is one
    share: float  # how far the wanted point lies towards the next one
    low: _End
    high: _End

    @property
    def inside(self) -> int:
        return max(0, self.high.less - self.low.upto)

    def test(self) -> str:
        x = col(self.metric)
        return f"{x} > {num(self.low.value)} AND {x} < {num(self.high.value)}"

    def cut_points(self) -> str:
        places = (
            min(1.0, max(0.0, (rank - self.low.upto) / self.inside + d))
            for rank, d in ((self.rank, -MARGIN), (self.last, MARGIN))
        )
        return f"percentile_approx(CASE WHEN {self.test()} THEN {col(self.metric)} END, array({', '.join(map(num, places))}), {ACCURACY})"

    def within(self, ends: list[_End]) -> _Bracket:
        """The piece between neighbouring ends that holds both order statistics.

        Ends are values that occur, so when the two statistics fall on both
        sides of an end, one of them is that end.
        """
        low = max((e for e in ends if e.less <= self.rank), key=lambda e: e.value)
        high = min((e for e in ends if e.upto > self.last and e.value >= low.value), key=lambda e: e.value)
        return _Bracket(self.metric, self.prob, self.rank, self.last, self.share, low, high)


def _whole(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> list[_Bracket]:
    """A bracket from least to greatest value for every column that has values."""
    figures = df.selectExpr(
        *(
            named(f"struct(count({x}) AS n, min({x}) AS low, max({x}) AS high)", c)
            for c, x in ((c, col(c)) for c in columns)
        )
    ).first()
    ends = _counted(df, [(c, v) for c in columns if figures[c].n for v in (figures[c].low, figures[c].high)])
    out = []
    for c in columns:
        for p in probs if figures[c].n else ():
            rank = math.floor(p * (figures[c].n - 1))
            last = min(rank + 1, figures[c].n - 1)
            low, high = ends[c, figures[c].low], ends[c, figures[c].high]
            out.append(_Bracket(c, p, rank, last, p * (figures[c].n - 1) - rank, low, high))
    return out


def _counted(df: DataFrame, values: Sequence[tuple[str, float]]) -> dict[tuple[str, float], _End]:
    """Rows below and up to each value of a column: one pass for all."""
    wanted = list(dict.fromkeys(values))
    if not wanted:
        return {}
    counts: Row = df.selectExpr(
        *(
            named(f"struct(count_if({col(c)} < {num(v)}) AS less, count_if({col(c)} <= {num(v)}) AS upto)", str(i))
            for i, (c, v) in enumerate(wanted)
        )
    ).first()
    return {(c, v): _End(v, counts[i].less, counts[i].upto) for i, (c, v) in enumerate(wanted)}


def _narrowed(df: DataFrame, brackets: list[_Bracket], keep: int) -> list[_Bracket]:
    """Cut every bracket until at most ``keep`` rows lie strictly inside.

    Cuts are taken from strictly inside, so each round makes a bracket smaller.
    """
    while large := [i for i, b in enumerate(brackets) if b.inside > keep]:
        found = df.selectExpr(*(named(brackets[i].cut_points(), str(i)) for i in large)).first()
        cuts = {i: [float(v) for v in found[str(i)]] for i in large}
        ends = _counted(df, [(brackets[i].metric, v) for i in large for v in cuts[i]])
        for i in large:
            b = brackets[i]
            brackets[i] = b.within([b.low, *(ends[b.metric, v] for v in cuts[i]), b.high])
    return brackets


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keep: int = KEEP) -> DataFrame:
    """Rows ``(metric, prob, value)``, interpolated linearly between order statistics.

    ``columns`` hold doubles; nulls do not count, and a column without any value
    yields no row. Copies of a value are counted before they meet, so at most
    ``keep`` and the two ends of a bracket are ever ranked together.
    """
    df = df.selectExpr(*(named(f"double({col(c)})", c) for c in columns))
    brackets = _narrowed(df, _whole(df, columns, probs), keep)
    # One row per metric and probability: as long as the registry, never the data.
    wanted = small_table(
        df.sparkSession,
        [(i, b.metric, b.prob, b.rank, b.share, b.low.less) for i, b in enumerate(brackets)],
        "at int, metric string, prob double, rank long, share double, below long",
    )
    hits = [
        f"CASE WHEN {col(b.metric)} BETWEEN {num(b.low.value)} AND {num(b.high.value)} "
        f"THEN named_struct('at', {i}, 'value', {col(b.metric)}) END"
        for i, b in enumerate(brackets)
    ]
    found = f"filter(array({', '.join(hits)}), hit -> hit IS NOT NULL)" if hits else "CAST(array() AS array<struct<at: int, value: double>>)"
    inside = df.selectExpr(f"inline({found})").groupBy("at", "value").agg(F.count(F.lit(1)).alias("copies"))
    so_far = (
        Window.partitionBy("at").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = inside.join(F.broadcast(wanted), "at").withColumn("upto", F.col("below") + F.sum("copies").over(so_far))
    at = F.min(F.when(F.col("upto") > F.col("rank"), F.col("value")))
    after = F.min(F.when(F.col("upto") > F.col("rank") + 1, F.col("value")))
    step = F.coalesce(after, at) - at
    return ranked.groupBy("metric", "prob", "share").agg((at + step * F.col("share")).alias("value")).drop("share")


def describe(df: DataFrame, columns: Sequence[str], digits: int = 3, keep: int = KEEP) -> DataFrame:
    """One row per column: count, mean, sample deviation, minimum, quartiles, maximum."""
    moments = df.selectExpr(
        *(
            named(
                f"struct({text(c)} AS metric, count({col(c)}) AS n, avg({col(c)}) AS mean, "
                f"stddev_samp({col(c)}) AS std, min({col(c)}) AS min, max({col(c)}) AS max)",
                c,
            )
            for c in columns
        )
    ).selectExpr(f"inline(array({', '.join(map(col, columns))}))")
    quartiles = (
        exact_quantiles(df, columns, (0.25, 0.5, 0.75), keep)
        .groupBy(F.col("metric").alias("of"))
        .agg(
            *(
                F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
            )
        )
    )
    figures = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return moments.join(quartiles, F.col("metric") == F.col("of"), "left").select(
        "metric", "n", *(F.expr(named(round_half_even(col(f), digits), f)) for f in figures)
    )
