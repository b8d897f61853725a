"""Small tables out of Python values."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table as long as a registry or a model. It enters the plan as a local
    relation, whose size the planner knows."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    table = pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=schema)
