"""Ranking without gathering a group, or the whole table, into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.expressions import col, named, round_half_even, text
from scoreloom.plans.staging import stage

# monotonically_increasing_id() is (task number << 33) + row number in the task.
_ROW_BITS = 33


def percentile_table(df: DataFrame, group: str, scores: Sequence[str]) -> DataFrame:
    """Percentile of every distinct score in its group: average rank over group size.

    Scores are rounded to 0.1 in 0..100, so a group has at most 1001 of them per
    measure. Counting comes first (combined map-side); the window then runs over
    the counts, and its partitions stay small however many rows a group has.
    """
    counts = (
        df.where(F.col(group).isNotNull())
        .unpivot([group], list(scores), "measure", "score")
        .where("score IS NOT NULL")
        .groupBy(group, "measure", "score")
        .agg(F.expr("count(*) AS ties"))
    )
    members = f"PARTITION BY {col(group)}, measure"
    so_far = f"sum(ties) OVER ({members} ORDER BY score ROWS UNBOUNDED PRECEDING)"
    share = f"({so_far} - (ties - 1) / 2D) / sum(ties) OVER ({members}) * 100D"
    return counts.selectExpr(col(group), "measure", "score", named(round_half_even(share), "pct"))


def group_percentiles(df: DataFrame, group: str, scores: Sequence[str]) -> DataFrame:
    """Add ``{score}_{group}_pct`` for every score; null score or group gives null.

    The table of percentiles is staged, so its size is known: the lookups are
    broadcasts while it is small, and shuffles (split by AQE where a score is
    frequent) once there are too many groups for that.
    """
    table = stage(percentile_table(df, group, scores), "percentiles")
    out = df
    for score in scores:
        one = table.where(f"measure = {text(score)}").selectExpr(
            col(group), named("score", score), named("pct", f"{score}_{group}_pct")
        )
        out = out.join(one, [group, score], "left")
    return out.select(*df.columns, *(f"{s}_{group}_pct" for s in scores))


def top_n(df: DataFrame, score: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` highest scores; ties by key, nulls last."""
    return df.orderBy(F.desc_nulls_last(score), F.asc(key)).limit(n)


def bottom_n(df: DataFrame, score: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` lowest scores; ties by key, nulls last."""
    return df.orderBy(F.asc_nulls_last(score), F.asc(key)).limit(n)


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number all rows from 1 in the given order, which must be total.

    A range-partitioned sort spreads the rows, ties included, over all tasks.
    Each task numbers its own rows and the table is staged, so those numbers
    are final; one start per task then turns them into positions.
    """
    slot = F.col("_slot")
    held = stage(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), name)
    block = F.shiftright(slot, _ROW_BITS)
    # One row per task of the sort: at most spark.sql.shuffle.partitions rows.
    sizes = held.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        held.withColumn("_block", block)
        .join(F.broadcast(starts), "_block")
        .withColumn(name, F.col("_start") + slot.bitwiseAND((1 << _ROW_BITS) - 1) + 1)
        .select(*df.columns, name)
    )


def with_group_position(
    df: DataFrame, group: str, order: Sequence[Column], name: str = "position"
) -> DataFrame:
    """Number the rows of each group from 1, a large group spread over many tasks."""
    placed = with_position(df, [F.asc(group), *order], name)
    firsts = stage(
        placed.groupBy(group).agg(F.min(name).alias("_first")), f"{name}-starts"
    )
    return (
        placed.join(firsts, placed[group].eqNullSafe(firsts[group]), "left")
        .drop(firsts[group])
        .withColumn(name, F.col(name) - F.col("_first") + 1)
        .drop("_first")
    )
