"""Scalar and aggregate expressions as SQL text, for ``expr`` and ``selectExpr``.

All are built-ins, so they stay inside whole-stage codegen. As text, a wide
registry reaches the JVM in one call rather than one call per operator.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from scoreloom.config import BANDS, LOWEST_BAND, RATING_EDGES, RATING_LETTERS, Archetype


def num(value: float | None) -> str:
    """A double literal. (A bare ``0.25`` would be a decimal.)"""
    if value is None:
        return "double(NULL)"
    return f"{float(value)!r}D" if math.isfinite(value) else f"double('{float(value)}')"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(expression: str, name: str) -> str:
    return f"{expression} AS {col(name)}"


def round_half_even(x: str, digits: int = 1) -> str:
    """Round as IEEE ``rint``: 0.25 becomes 0.2. SQL ``round`` would give 0.3."""
    scale = num(10**digits)
    return f"rint(({x}) * {scale}) / {scale}"


def clip(x: str, low: float, high: float) -> str:
    """Limit to ``[low, high]``, keeping nulls (``greatest``/``least`` skip them)."""
    return f"CASE WHEN {x} < {num(low)} THEN {num(low)} WHEN {x} > {num(high)} THEN {num(high)} ELSE {x} END"


def penalty(x: str, cap: float = 4.0, points: float = 10.0) -> str:
    """Points lost for a count: none at 0, all of them at ``cap`` and beyond."""
    return f"({clip(f'double({x})', 0.0, cap)}) / {num(cap)} * {num(points)}"


def rating(
    score: str, edges: Sequence[float] = RATING_EDGES, letters: Sequence[str] = RATING_LETTERS
) -> str:
    """Letter of the right-closed bin holding the score; null outside every bin."""
    bins = " ".join(
        f"WHEN {score} > {num(low)} AND {score} <= {num(high)} THEN {text(letter)}"
        for low, high, letter in zip(edges, edges[1:], letters)
    )
    return f"CASE {bins} END"


def band(score: str) -> str:
    """Band of a score, lower bounds included. A null score is in the lowest band."""
    bounds = " ".join(f"WHEN {score} >= {num(bound)} THEN {text(name)}" for bound, name in BANDS)
    return f"CASE {bounds} ELSE {text(LOWEST_BAND)} END"


def lookup(x: str, mapping: Mapping[str, str]) -> str:
    """Value of ``x`` in a small fixed mapping; null when absent."""
    return f"CASE {x} " + " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in mapping.items()) + " END"


def mean_of_rounded(score: str, digits: int = 1) -> str:
    """Average of already rounded scores.

    The sum runs over integers, so the result is the same however the rows are
    spread over tasks.
    """
    scale = num(10**digits)
    return f"sum(bigint(rint({score} * {scale}))) / {scale} / count({score})"


def row_mean(columns: Sequence[str]) -> str:
    """Mean across columns of one row, nulls skipped; null if all are null."""
    total = " + ".join(f"coalesce({c}, 0D)" for c in columns)
    present = " + ".join(f"int({c} IS NOT NULL)" for c in columns)
    return f"({total}) / nullif({present}, 0)"


def archetype(measures: Mapping[str, str], rules: Sequence[Archetype], default: str) -> str:
    """Name of the first rule whose conditions all hold."""
    cases = " ".join(
        "WHEN "
        + " AND ".join(f"{measures[name]} {how} {num(bound)}" for name, how, bound in rule.conditions)
        + f" THEN {text(rule.name)}"
        for rule in rules
    )
    return f"CASE {cases} ELSE {text(default)} END" if rules else text(default)


def percent_text(share: str) -> str:
    """A share as text with one decimal and a percent sign, rounded half-even."""
    return f"format_string('%.1f%%', {round_half_even(f'{share} * 100')})"


def score_text(score: str, letter: str) -> str:
    """``"75.9 (A)"``; a missing part is written ``nan``."""
    return f"concat(coalesce(string({score}), 'nan'), ' (', coalesce({letter}, 'nan'), ')')"


def nan_to_null(x: str) -> str:
    return f"CASE WHEN NOT isnan({x}) THEN {x} END"
