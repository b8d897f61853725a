"""Universe-wide min-max scaling.

One aggregate finds all bounds; that one row comes to the driver and enters
every later projection as literals. Constant and empty columns are settled
while the plan is built, so the generated code per row stays small, and the
universe is scanned for its bounds once however many results use them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from scoreloom.config import Metric, Scorecard
from scoreloom.functions.expressions import col, named, num

Range = tuple[float | None, float | None]


def scaling_input(metric: Metric, linear: bool = False) -> str:
    """The value that gets scaled; ``linear`` ignores the metric's log transform."""
    x = f"double({col(metric.column)})"
    return f"log1p({x})" if metric.log1p and not linear else x


def universe_bounds(df: DataFrame, inputs: Mapping[str, str]) -> DataFrame:
    """One row with the minimum and maximum of every input."""
    return df.selectExpr(
        *(
            named(f"{end}({x})", f"{name}_{suffix}")
            for name, x in inputs.items()
            for end, suffix in (("min", "lo"), ("max", "hi"))
        )
    )


def find_bounds(df: DataFrame, inputs: Mapping[str, str]) -> dict[str, Range]:
    """Minimum and maximum of every input, null where a column has no value."""
    row = universe_bounds(df, inputs).first()
    return {name: (row[f"{name}_lo"], row[f"{name}_hi"]) for name in inputs}


def min_max_100(x: str, bounds: Range, invert: bool = False) -> str:
    """Scale to 0..100. A constant column is 50 on every row, null rows included;
    a column without values stays null."""
    lo, hi = bounds
    if lo is None:
        return num(None)
    if lo == hi:
        return num(50)
    scaled = f"({x} - {num(lo)}) / {num(hi - lo)} * 100D"
    return f"100D - {scaled}" if invert else scaled


def min_max_01(x: str, bounds: Range, invert: bool = False) -> str:
    """Scale to 0..1. Without a spread (constant, or no values) every row is 0.5."""
    lo, hi = bounds
    if lo is None or lo == hi:
        return num(0.5)
    scaled = f"({x} - {num(lo)}) / {num(hi - lo)}"
    return f"1D - {scaled}" if invert else scaled


def linear_inputs(metrics: Iterable[Metric]) -> dict[str, str]:
    return {m.column: scaling_input(m, linear=True) for m in metrics}


def normalise_01(df: DataFrame, card: Scorecard, keep: Iterable[str]) -> DataFrame:
    """``keep`` columns plus all metrics scaled linearly to 0..1, higher is better."""
    inputs = linear_inputs(card.metrics)
    bounds = find_bounds(df, inputs)
    return df.selectExpr(
        *map(col, keep),
        *(
            named(min_max_01(inputs[m.column], bounds[m.column], m.lower_is_better), m.column)
            for m in card.metrics
        ),
    )


def normalise_100(df: DataFrame, card: Scorecard, keep: Iterable[str]) -> DataFrame:
    """``keep`` columns plus the scaled metrics at 0..100, log transforms applied."""
    inputs = {m.column: scaling_input(m) for m in card.scaled}
    bounds = find_bounds(df, inputs)
    return df.selectExpr(
        *map(col, keep),
        *(
            named(min_max_100(inputs[m.column], bounds[m.column], m.lower_is_better), m.column)
            for m in card.scaled
        ),
    )
