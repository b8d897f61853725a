"""From raw documents to tokens: five stages, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a table. All but the last return
the columns of documents. Near-duplicate stages take five-word shingles and a
similarity of 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.line_dedup import without_repeats
from scoreloom.llm.mixing import mixed_documents
from scoreloom.llm.ngram_join import without_similar
from scoreloom.llm.piece_tokens import encoded
from scoreloom.llm.quality import clean_documents
from scoreloom.llm.queries import PIECES
from scoreloom.plans.staging import release, stage


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars as the text is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines their host repeats.

    A text that is null or too short fails; a null source is a host of its own,
    rows without doc_id count as one document there. Equal rows stay or go together.
    """
    return _recounted(clean_documents(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go; a document of which no word is left goes with them.

    Texts without repeats, null and empty ones included, stay as they are; rows
    without doc_id stand first; equal rows are one document.
    """
    left = without_repeats(docs).where(r"n_removed = 0 OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    return _recounted(left.select(*docs.columns))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of similar texts stays, the one with the least doc_id.

    Rows are told apart by doc_id and text, so a text never goes because another
    one under its doc_id is a copy. Of rows equal in both one stays; texts without
    words, null ones included, all stay.
    """
    return without_similar(docs, k=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; texts without words are not taken, a null source stands last."""
    return mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids; the text is in them. A null text has null ids and no tokens."""
    return encoded(docs, PIECES).selectExpr("doc_id", "lang", "source", "bigint(coalesce(size(ids), 0)) AS n_tokens", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# The mix rounds by keyed coins, which SQL cannot express; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES:
        after = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            release(before)
        docs = before = after
    return docs
