"""Removal of repeated line runs by a distributed suffix array over line IDs.

A document is the sequence of its lines that have a word. Suffixes of these
sequences are sorted by prefix doubling: the rank of a suffix by its first 2h
lines is the rank of the pair (rank at h, rank at h of the suffix h lines on).
Pairs are ranked by a range-partitioned sort, one written table a round, so no
task holds more than its range. A suffix that stands alone is settled and
leaves the rounds; lines that occur once never enter them.

Runs count once they have ``min_words`` words. How many lines that takes, w,
follows from the run itself, and is at most ``min_words``, so that is how deep
the doubling goes at most. Suffixes whose common prefix reaches w lines form
one interval of the suffix array; two overlapping ranks, of the first and the
last 2^j of the w lines, tell the intervals apart. In every interval the first
suffix in document order stays, and the lines of the others' runs go. Of a
longer run the last lines stay if no window inside it reaches them, as the SQL
twin has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.operators.rank import with_position
from scoreloom.plans.staging import release, stage

MIN_WORDS = 50
SUFFIX = ["did", "txt", "i"]
_FLUSH = 50_000


def _lines(text: str | None) -> list[tuple[bytes, int]]:
    """Normalised lines that have a word, and their words: single spaces, A-Z as a-z."""
    found = (line.lower().split() for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"))
    return [(b" ".join(words), len(words)) for words in found if words]


def _suffixes(min_words: int):
    """A row for each line: its place, its ID, and the lines a run from here needs (null if the text ends before)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for did, txt, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = _lines(text)
                before = np.cumsum([0, *(n for _, n in lines)])
                ends = np.searchsorted(before, before[:-1] + min_words)
                for i, (line, _) in enumerate(lines):
                    need = int(ends[i]) - i
                    rows.append((did, txt, i, blake2b(line, digest_size=16).digest(), need if ends[i] <= len(lines) else None))
                if len(rows) >= _FLUSH:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["did", "txt", "i", "line", "need"])


def _identified(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("coalesce(CAST(doc_id AS bigint), -9223372036854775808) AS did", "xxhash64(CAST(text AS string)) AS txt", "CAST(text AS string) AS text")


def rank_levels(docs: DataFrame, min_words: int = MIN_WORDS) -> list[DataFrame]:
    """Written tables ``did, txt, i, need, rank``: at place j the ranks by the first 2^j lines, of suffixes that share them."""
    every = stage(
        _identified(docs).where("text IS NOT NULL").mapInArrow(_suffixes(min_words), "did long, txt long, i int, line binary, need int"),
        "lines",
    )
    often = every.groupBy("line").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("line")
    ranked = stage(with_position(often, [F.asc("line")], "rank"), "line-ranks")
    now = stage(every.join(ranked, "line").select(*SUFFIX, "need", "rank").dropDuplicates(SUFFIX), "ranks")
    release(every, ranked)
    levels, h = [now], 1
    while 2 * h <= min_words and not now.isEmpty():
        ahead = Window.partitionBy("did", "txt").orderBy("i").rangeBetween(h, h)  # the one row h lines on
        pairs = stage(now.withColumn("then", F.max("rank").over(ahead)).where("then IS NOT NULL"), "rank-pairs")
        often = pairs.groupBy("rank", "then").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("rank", "then")
        ranked = with_position(often, [F.asc("rank"), F.asc("then")], "next")
        now = stage(pairs.join(ranked, ["rank", "then"]).select(*SUFFIX, "need", F.col("next").alias("rank")), "ranks")
        release(pairs)
        levels.append(now)
        h *= 2
    return levels


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``did, txt, i, need, first``: the runs from line ``i`` that an earlier place has too."""
    levels, found = rank_levels(docs, min_words), []
    for j, level in enumerate(levels):
        here = level.where(f"need >= {1 << j} AND need < {2 << j}").select(*SUFFIX, "need", F.col("rank").alias("head"), F.expr(f"i + need - {1 << j}").alias("at"))
        last = level.select("did", "txt", F.col("i").alias("at"), F.col("rank").alias("tail"))
        found.append(here.join(last, ["did", "txt", "at"]).select(*SUFFIX, "need", "head", "tail"))
    windows = stage(reduce(DataFrame.union, found), "windows")
    release(*levels)
    interval = ["need", "head", "tail"]
    firsts = windows.groupBy(*interval).agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(*SUFFIX)).alias("first")).where("rows > 1")
    return windows.join(firsts.drop("rows"), interval).where(F.struct(*SUFFIX) != F.col("first")).select(*SUFFIX, "need", "first")


def _cut(columns: int, place: int):
    """Take the removed lines off each text; blank lines that follow a removed line go with it."""

    def cut(text: str | None, gone: list[int] | None) -> tuple[str | None, int]:
        if text is None or not gone:
            return text, 0
        out, removed, lost, at = [], frozenset(gone), False, -1
        for line in text.split("\n"):
            if line.encode("utf-8", "surrogatepass").split():
                at += 1
                lost = at in removed
            if not lost:
                out.append(line)
        return "\n".join(out), len(removed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [cut(t, g) for t, g in zip(batch.column(place).to_pylist(), batch.column(columns).to_pylist())]
            out = [batch.column(i) for i in range(columns)]
            out[place] = pa.array([t for t, _ in done], pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array([n for _, n in done], pa.int64())], names=[f"c{i}" for i in range(columns + 1)])

    return run


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs (doc_id, text, ...)`` with later copies of repeated line runs taken off; ``n_removed`` lines went.

    Lines compare by their words, A-Z as a-z and other letters as they are. Copies are ordered by doc_id,
    then place; a null doc_id stands first. A line that overlaps its own earlier
    copy goes too. A null text stays null; text without repeats stays as it is to
    the byte. Equal rows are one document, and each keeps what it keeps. All
    columns stay; an n_removed that the input has is replaced.
    """
    base = docs.drop("n_removed")
    names = base.columns
    gone = (
        repeated_runs(docs, min_words)
        .groupBy("did", "txt")
        .agg(F.expr("array_distinct(flatten(collect_list(sequence(i, i + need - 1))))").alias("gone"))  # lines of one document
        .toDF("__did", "__txt", "__gone")
    )
    gone = stage(gone, "removed")
    marked = base.withColumn("__did", F.expr("coalesce(CAST(doc_id AS bigint), -9223372036854775808)")).withColumn("__txt", F.expr("xxhash64(CAST(text AS string))"))
    # One plan at every size: both sides meet by document.
    joined = marked.join(gone.hint("merge"), ["__did", "__txt"], "left").select(*[F.col(f"`{c}`") for c in names], "__gone")
    fields = [T.StructField(f"c{i}", T.StringType() if f.name == "text" else f.dataType) for i, f in enumerate(base.schema)]
    schema = T.StructType([*fields, T.StructField(f"c{len(names)}", T.LongType())])
    return joined.mapInArrow(_cut(len(names), names.index("text")), schema).toDF(*names, "n_removed")
