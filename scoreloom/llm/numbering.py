"""Numbers for rows that share a key, however many they are.

Wholly equal rows are counted, not sorted, and come back one by one from their
count; so neither a window nor a cell holds them, and the numbers do not depend
on where a row was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP = 1 << 12  # numbers of one row's array


def repeated_rows(rows: DataFrame, count: str, name: str) -> DataFrame:
    """Every row as often as its ``count`` says, with its number from 0 in ``name`` and without the count."""
    parts = rows.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / STEP)))).where(F.col(count) > 0)
    first = F.col("__part") * STEP
    return parts.withColumn(name, F.explode(F.sequence(first, F.least(first + STEP, F.col(count)) - 1))).drop("__part", count)


def numbered(rows: DataFrame, key: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with their number from 0 among those of equal ``key`` (nulls are equal), in ``name``.

    ``order`` tells rows apart that differ; wholly equal ones get successive
    numbers. Columns must be of types that can be grouped by.
    """
    kinds = rows.groupBy(*[f"`{c}`" for c in rows.columns]).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    begun = kinds.withColumn("__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    return repeated_rows(begun, "__rows", "__at").withColumn(name, F.col("__first") + F.col("__at")).drop("__first", "__at")
