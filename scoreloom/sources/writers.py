"""Sinks: marts as CSV or parquet folders, metadata as one JSON record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "csv", partition_by: str | None = None, file_rows: int | None = None) -> None:
    """Write one mart; CSV gets a header, doubled quotes and its blanks as they are.

    Without ``partition_by`` every task writes its own file. With it there is a
    folder for each of its values, and rows are first balanced by it: Spark brings
    a small group to one task, so to one file, and deals a large one out to as
    many as its size asks for. ``file_rows`` limits the rows of a file besides.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.format(fmt).save(path)


def write_marts(
    marts: Mapping[str, DataFrame], folder: str, fmt: str = "csv", partition_by: str | None = None, file_rows: int | None = None
) -> None:
    """Write every mart below ``folder``; those that have the column ``partition_by`` are partitioned by it."""
    for name, df in marts.items():
        by = partition_by if partition_by in df.columns else None
        write_table(df, f"{folder.rstrip('/')}/{name}", fmt, by, file_rows)


def write_record(record: DataFrame, path: str) -> None:
    """Write a one-row table as JSON."""
    record.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
