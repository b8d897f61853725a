"""Language identification with bit-sliced Bloom filters of character n-grams.

One table holds the filters of all languages at once: a row for each filter
position, a bit for each language. The rows of an n-gram's positions, ANDed,
give the languages that contain it. A document's hits are counted per language
over its whole text, each count is freed of the false positives its filter's
filling makes likely, and the greatest count decides.

An n-gram is in a language if it is not rare there, and not much rarer than
where it is most common. Both bounds are shares, so the table does not fill up
as the training sample grows; the sample itself is bounded by ``TRAIN_DOCS``
documents a language. n-grams are of 2 to 4 letters in lower case, word ends
included.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.words import mix, slices
from scoreloom.plans.staging import release, stage

SIZES = (2, 3, 4)
TRAIN_DOCS = 5_000  # expected documents of a language in the sample, chosen by hash
BITS = 21  # 2,097,152 positions of 1 to 8 bytes for every 64 languages, broadcast; three of them from one hash
LEAST_SHARE = 1e-5  # of a language's n-grams of that size: so no more than 100,000 of them
LEAST_RATIO = 0.2  # to the share where the n-gram is most common
UNKNOWN = "und"
_U = np.uint64
_MASK = _U((1 << BITS) - 1)
_PART = 1 << 13


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By size: hashes of all n-grams of the texts, and where each text's begin (one more at the end)."""
    joined = [f"\n{(t or '').lower()}" for t in texts]
    codes = np.frombuffer("".join([*joined, "\n"]).encode("utf-32-le", "surrogatepass"), np.uint32)
    heads = np.cumsum([0, *map(len, joined)])
    letter = _letters()[np.minimum(codes, 0x10FFFF)]
    keep = letter | np.concatenate(([False], letter[:-1]))  # letters, and one mark after a word
    keep[heads] = True
    marked = np.where(letter, codes, 0)[keep].astype(_U)
    begins = np.concatenate(([0], np.cumsum(keep)))[heads]
    solid, n = marked != 0, len(marked)
    weights = mix(np.arange(1, max(SIZES) + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
    total = marked * weights[0]
    for size in range(2, max(SIZES) + 1):
        total = total[: n - size + 1] + marked[size - 1 :] * weights[size - 1]
        whole = solid[: n - 1] | solid[1:] if size == 2 else np.ones(n - size + 1, bool)
        for inner in range(1, size - 1):  # one word only
            whole &= solid[inner : n - size + 1 + inner]
        if size in SIZES:
            yield size, mix(total[whole] + _U(size)), np.concatenate(([0], np.cumsum(whole)))[np.minimum(begins, len(whole))]


def _counts(languages: list[str]):
    """How often each n-gram is in each language, summed over the task."""
    place = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], pd.Series] = {}
        for batch in batches:
            frame = batch.to_pandas()
            for lang, texts in frame.groupby("lang")["text"]:
                texts = texts.tolist()
                for a, b in slices(texts):
                    for size, found, _ in _grams(texts[a:b]):
                        values, counts = np.unique(found, return_counts=True)
                        own = pd.Series(counts, index=values.view(np.int64))
                        key = (place[lang], size)
                        held[key] = held[key].add(own, fill_value=0) if key in held else own
        for (lang, size), counts in held.items():
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, lang, np.int32)), pa.array(np.full(n, size, np.int32)), pa.array(counts.index.to_numpy()), pa.array(counts.to_numpy().astype(np.int64))],
                names=["lang", "size", "gram", "n"],
            )

    return run


def _slices_of(kind: np.dtype):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        """The rows of one stretch of the table."""
        out = np.zeros(_PART, kind)
        out[part["position"].to_numpy() % _PART] = part["mask"].to_numpy().astype(np.int64).view(_U).astype(kind)
        return pd.DataFrame({"word": [part["word"].iloc[0]], "part": [part["part"].iloc[0]], "bits": [out.tobytes()]})

    return run


class Filters:
    """The learned table; ``languages`` in the order of their bits."""

    def __init__(self, languages: list[str], words: list[np.ndarray], prior: list[int]):
        self.languages, self.words = languages, words
        # Ties go to the language with more training documents, then by code point.
        self.order = sorted(range(len(languages)), key=lambda i: (-prior[i], languages[i].encode()))
        self.wrong = np.zeros(len(languages))
        for i in range(len(languages)):
            filled = np.count_nonzero((words[i // 64] >> (i % 64)) & 1) / (1 << BITS)
            self.wrong[i] = min(filled**3, 0.99)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n, hits = np.zeros(len(texts)), np.zeros((len(self.languages), len(texts)))
        for _, found, begins in _grams(texts):
            n += np.diff(begins)
            at = [(found >> _U(shift * BITS)) & _MASK for shift in range(3)]
            for word, table in enumerate(self.words):
                mask = table[at[0]] & table[at[1]] & table[at[2]]
                for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                    sums = np.concatenate(([0], np.cumsum((mask >> (i % 64)) & 1, dtype=np.int64)))
                    hits[i] += sums[begins[1:]] - sums[begins[:-1]]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        right = np.maximum(hits - self.wrong[:, None] * n, 0) / (1 - self.wrong[:, None])
        best = np.array(self.order)[right[self.order].argmax(0)]
        score = np.clip(right[best, np.arange(len(texts))] / np.maximum(n, 1), 0, 1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n)], np.where(n > 0, score, 0.0)


def learn(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> Filters:
    """The filters of every language in ``labelled (doc_id, text, lang)``; rows without text or lang are left out."""
    rows = labelled.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text", "CAST(lang AS string) AS lang").where("lang IS NOT NULL AND text IS NOT NULL")
    prior = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    languages = sorted(prior, key=lambda s: s.encode())
    if not languages:
        return Filters([], [], [])
    kept = F.lit(1.0)
    for name in languages:
        if prior[name] > train_docs:
            kept = F.when(F.col("lang") == name, F.lit(train_docs / prior[name])).otherwise(kept)
    draw = F.expr("shiftrightunsigned(xxhash64(doc_id, 7), 11) * 1.1102230246251565E-16D")
    counts = rows.where(draw < kept).select("lang", "text").mapInArrow(_counts(languages), "lang int, size int, gram long, n long")
    counts = stage(counts.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {(r.lang, r["size"]): r.n for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}  # a row for each language and size
    total = F.lit(1)
    for (lang, size), n in totals.items():
        total = F.when((F.col("lang") == lang) & (F.col("size") == size), F.lit(n)).otherwise(total)
    shares = counts.withColumn("share", F.col("n") / total)
    most = shares.groupBy("size", "gram").agg(F.collect_list(F.struct("lang", "share")).alias("in"), F.max("share").alias("most"))  # a few languages
    chosen = most.selectExpr("gram", "most", "inline(in)").where((F.col("share") >= LEAST_SHARE) & (F.col("share") >= LEAST_RATIO * F.col("most")))
    positions = ", ".join(f"int(shiftrightunsigned(gram, {i * BITS}) & {int(_MASK)})" for i in range(3))
    table = (
        chosen.selectExpr("lang div 64 AS word", "shiftleft(1L, int(lang % 64)) AS bit", f"explode(array({positions})) AS position")
        .groupBy("word", "position").agg(F.bit_or("bit").alias("mask"))
        .selectExpr("word", f"position div {_PART} AS part", "position", "mask")
    )
    kind = np.dtype(next(f"u{b}" for b in (1, 2, 4, 8) if len(languages) <= 8 * b or b == 8))
    words = [np.zeros(1 << BITS, kind) for _ in range(-(-len(languages) // 64))]
    # 256 rows of fixed size for every 64 languages.
    for r in table.groupBy("word", "part").applyInPandas(_slices_of(kind), "word long, part long, bits binary").collect():
        words[r.word][r.part * _PART : (r.part + 1) * _PART] = np.frombuffer(r.bits, kind)
    release(counts)
    return Filters(languages, words, [prior[name] for name in languages])


def identified(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs (doc_id, text)``.

    A null text, or one without letters, is ``und`` with score 0. The score is
    the share of the document's n-grams that the language holds, false
    positives taken off. Equal counts go to the language with more training
    documents. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                langs, scores = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    rows = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
