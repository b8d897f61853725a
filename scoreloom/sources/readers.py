"""Entity tables from files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.config import Scorecard
from scoreloom.functions.expressions import col, nan_to_null

# The texts a CSV cell may hold for "no value".
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def clean_name(name: str) -> str:
    """Trim a header and join its words with underscores."""
    return re.sub(r"\s+", "_", name.strip())


def clean_header(df: DataFrame) -> DataFrame:
    return df.toDF(*(clean_name(c) for c in df.columns))


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into null: Spark would otherwise rank it above every number."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.expr(nan_to_null(col(c))) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """A headered CSV under a fixed schema, matched by cleaned header name.

    Only header lines are looked at beforehand; every file of a folder must have
    the same one. Quotes inside quoted cells are doubled. Line ends inside cells
    need ``multi_line``, which keeps Spark from splitting files. Cells are read
    as text, the null texts become null, and anything else that does not fit its
    type is an error, whatever the session's ANSI mode. Columns outside the
    schema stay text.
    """
    types = {f.name: f.dataType for f in T.StructType.fromDDL(schema)} if isinstance(schema, str) else {
        f.name: f.dataType for f in schema
    }
    style = {"header": True, "escape": '"', "multiLine": multi_line}
    header = spark.read.csv(path, **style).columns
    names = [clean_name(c) for c in header]
    missing = [c for c in types if c not in names]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    # With enforceSchema off, a file whose own header differs is refused.
    raw = spark.read.csv(path, schema=text, enforceSchema=False, mode="FAILFAST", **style).toDF(*names)

    def cell(c: str):
        kept = F.when(~F.trim(c).isin(*NULL_TEXTS), F.col(c))
        if c not in types or types[c] == T.StringType():
            return kept.alias(c)
        fits = F.trim(kept).try_cast(types[c])
        wrong = F.raise_error(F.concat(F.lit(f"{c}: not a {types[c].simpleString()}: "), kept)).cast(types[c])
        return F.when(kept.isNotNull() & fits.isNull(), wrong).otherwise(fits).alias(c)

    return raw.select(*(cell(c) for c in names))


def read_entities(
    spark: SparkSession, path: str, card: Scorecard, fmt: str = "csv", columns: Sequence[str] | None = None
) -> DataFrame:
    """Entities ready for scoring: clean header, nulls for NaN, no row without a key."""
    if fmt == "csv":
        df = read_csv(spark, path, card.schema)
    else:
        df = clean_header(spark.read.format(fmt).load(path))
    df = nulls_for_nan(df).na.drop(subset=[card.key])
    return df.select(*columns) if columns else df
