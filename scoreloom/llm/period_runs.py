"""Periodic runs of words, found in tiles of every scale and stitched.

A run is a longest stretch of words that repeats with its smallest period q and
has at least ``max(6, 4 q)`` words. Periods are handled by octave, P to 2P - 1:

1. A document lies under tiles of 8P words around boundaries 2P apart; their
   number falls as their size grows, so all octaves together take n log n. Tiles
   are cut inside the task that reads the document, block by block, and no tile
   needs another one.
2. A run holds a boundary b in its first 2P words, and there the words from b
   and those from b + q agree over P words at least. Rolling hashes of P words
   leave the few (b, q) for which that may be so; those whose q consists of equal
   shorter periods go too, as the shorter period tells the same run.
3. For what is left the Z-functions at the boundary, forwards and backwards
   within the tile, give the exact fragment of the run inside the tile. One that
   ends inside the tile on both sides and is too short is no part of a run.
4. Fragments of one block that continue one another are joined; they are
   shuffled by (document, period) and stitched where they overlap by q words.

Texts are written once, beside their fragments; only those of documents with
fragments are shuffled. Equal words have equal numbers inside a slice of texts,
so nothing but the filters of step 2 relies on hashes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.words import mix, slices
from scoreloom.plans.staging import stage

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
BLOCK_CELLS = 1 << 18  # of (boundary, period) compared at once
_U = np.uint64
_BASE = 0xD1342543DE82EF95  # odd, hence invertible modulo 2**64

RUNS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
)
_FRAGMENT = pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
_FRAGMENTS = "array<struct<period:bigint,start:bigint,stop:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: longest stretches without space, tab, LF, VT, FF, CR."""
    return (text or "").encode("utf-8", "surrogatepass").split()


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, _U), np.full(size, pow(_BASE, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@lru_cache(maxsize=2)
def _least_factors(size: int) -> np.ndarray:
    """The least prime factor of every number below ``size``."""
    out = np.arange(size)
    for f in range(2, int(size**0.5) + 1):
        if out[f] == f:
            several = out[f * f :: f]
            several[several == np.arange(f * f, size, f)] = f
    return out


class _Slice:
    """The words of some documents as numbers, one document after the other."""

    def __init__(self, docs: Sequence[list[bytes]]):
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        self.size = np.array([len(d) for d in docs], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.word = np.fromiter((numbers[w] for d in docs for w in d), np.int64, int(self.size.sum()))
        up, self.down = _powers(1 << max(len(self.word), 1).bit_length())
        self.sums = np.concatenate((np.zeros(1, _U), np.cumsum(mix(self.word.astype(_U) + _U(1)) * up[: len(self.word)])))

    def hashes(self, at: np.ndarray, length) -> np.ndarray:
        """Of the ``length`` words from every place of ``at``."""
        return (self.sums[at + length] - self.sums[at]) * self.down[at]

    def fragments(self, cells: int) -> Iterator[tuple[np.ndarray, ...]]:
        """``document, period, start, stop`` of the fragments of every block of tiles."""
        p = 1
        while (docs := np.flatnonzero(self.size >= max(LEAST, TIMES * p))).size:
            # Boundaries from which a period of P and a window of P words still fit in.
            count = (self.size[docs] - 2 * p) // (2 * p) + 1
            doc = np.repeat(docs, count)
            place = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * 2 * p
            step = max(1, cells // p)
            for a in range(0, len(doc), step):
                yield from self._block(p, doc[a : a + step], place[a : a + step])
            p *= 2

    def _block(self, p: int, doc: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        at, end = self.first[doc] + place, self.first[doc] + self.size[doc]
        far = at[:, None] + np.arange(p, 2 * p)
        fits = far + p <= end[:, None]
        same = fits & (self.hashes(np.where(fits, far, 0), np.where(fits, p, 0)) == self.hashes(at, p)[:, None])
        row, period = np.nonzero(same)
        if not len(row):
            return
        period += p
        at, low, end, doc = at[row], np.maximum(self.first[doc], at - 2 * p)[row], np.minimum(end, at + 6 * p)[row], doc[row]
        whole = self._primitive(at, period)
        at, low, end, doc, period = at[whole], low[whole], end[whole], doc[whole], period[whole]
        if not len(at):
            return
        stop = at + period + self._agree(at, period, np.minimum(end - at - period, 6 * p), 1)
        start = at - self._agree(at - 1, period, at - low, -1)
        base = self.first[doc]
        # What the tile does not cut off is as long as it is, and goes if that is too short.
        cut = ((start == low) & (low > base)) | ((stop == np.minimum(end, at + period + 6 * p)) & (stop < base + self.size[doc]))
        kept = cut | (stop - start >= np.maximum(LEAST, TIMES * period))
        yield _joined(doc[kept], period[kept], (start - base)[kept], (stop - base)[kept])

    def _primitive(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether the ``period`` words from ``at`` are no repetition of fewer words."""
        out = np.ones(len(at), bool)
        factors = _least_factors(1 << int(period.max()).bit_length())
        rest, own = period.copy(), np.flatnonzero(period > 1)
        while own.size:
            f = factors[rest[own]]
            d = period[own] // f
            even = self.hashes(at[own], period[own] - d) == self.hashes(at[own] + d, period[own] - d)
            out[own[even]] = False
            rest[own] //= f
            own = own[~even & (rest[own] > 1)]
        return out

    def _agree(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """Z-functions: for how many words, ``most`` at most, those from ``at`` and those a period on agree."""
        out = np.zeros(len(at), np.int64)
        width = 16
        open_ = np.flatnonzero(most > 0)
        while open_.size:
            here = []
            for a in range(0, len(open_), max(1, BLOCK_CELLS // width)):
                own = open_[a : a + max(1, BLOCK_CELLS // width)]
                ahead = out[own, None] + np.arange(width)
                valid = ahead < most[own, None]
                near = np.where(valid, at[own, None] + way * ahead, 0)
                equal = valid & (self.word[near] == self.word[np.where(valid, near + period[own, None], 0)])
                run = np.where(equal.all(1), width, equal.argmin(1))
                out[own] += run
                here.append(own[(run == width) & (out[own] < most[own])])
            open_, width = np.concatenate(here), min(2 * width, 1 << 12)
        return out


def _joined(doc: np.ndarray, period: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fragments of neighbouring tiles that overlap by their period, as one."""
    order = np.lexsort((start, period, doc))
    doc, period, start, stop = doc[order], period[order], start[order], stop[order]
    fresh = np.ones(len(doc), bool)
    # Tiles lie in order, so ends do too: the one before reaches furthest.
    fresh[1:] = (doc[1:] != doc[:-1]) | (period[1:] != period[:-1]) | (start[1:] > stop[:-1] - period[1:])
    at = np.flatnonzero(fresh)
    return doc[at], period[at], start[at], np.maximum.reduceat(stop, at)


def _scan(place: int, names: list[str], cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for a, b in slices(texts):
                parts = list(_Slice([words_of(t) for t in texts[a:b]]).fragments(cells))
                doc, *rest = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
                order = np.argsort(doc, kind="stable")
                values = pa.StructArray.from_arrays([pa.array(x[order]) for x in rest], fields=list(_FRAGMENT))
                ends = np.searchsorted(doc[order], np.arange(b - a + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), lists], names=names)

    return run


def _collapse(place: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs, made = batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), []
            for text, own in zip(texts, runs):
                words = words_of(text)
                if own:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for r in own:
                        gone[r["start"] + r["period"]] += 1
                        gone[r["start"] + r["length"]] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                made.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=names)

    return run


def stitched(fragments: DataFrame) -> DataFrame:
    """``row, start, length, period`` of the runs that ``fragments (row, period, start, stop)`` make up.

    Fragments of one row and period that overlap by the period are one stretch;
    stretches that are long enough count, each with its smallest period.
    """
    line = Window.partitionBy("row", "period").orderBy("start", "stop")
    before = F.max("stop").over(line.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("fresh", F.when(before - F.col("period") >= F.col("start"), 0).otherwise(1))
    numbered = marked.withColumn("part", F.sum("fresh").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = numbered.groupBy("row", "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    long = stretches.where(f"stop - start >= greatest({LEAST}, {TIMES} * period)")
    return long.groupBy("row", "start", "stop").agg(F.min("period").alias("period")).selectExpr("row", "start", "stop - start AS length", "period")


def periodic_runs(docs: DataFrame, column: str = "text", cells: int = BLOCK_CELLS) -> DataFrame:
    """``docs`` with its ``runs`` and the ``collapsed`` text, without what repeats.

    ``runs`` has the start (word number from 0), length and period of every run,
    by start, then period. ``collapsed`` joins by one space the words that no run
    contains after its first period. A null or empty text has no runs and
    collapses to an empty text. Every row is its own, equal ones too; all columns
    stay, those called ``runs`` or ``collapsed`` are replaced. Words are compared
    as they are, case included.
    """
    names = [c for c in docs.columns if c not in ("runs", "collapsed")]
    place = names.index(column)
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    inner = plain.columns
    keyed = plain.withColumn("row", F.monotonically_increasing_id())
    schema = T.StructType([*keyed.schema.fields, T.StructField("fragments", T._parse_datatype_string(_FRAGMENTS))])
    # Written once: the numbers of rows must not change any more.
    scanned = stage(keyed.mapInArrow(_scan(place, schema.names, cells), schema), "fragments")

    pieces = scanned.where("size(fragments) > 0").selectExpr("row", "inline(fragments)")
    runs = (
        stitched(pieces)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("own"))
        .selectExpr("row", "transform(own, r -> struct(r.start AS start, r.length AS length, r.period AS period)) AS runs")
    )
    some = scanned.where("size(fragments) > 0").select("row", *inner).hint("merge").join(runs, "row", "left").select(*inner, "runs")
    none = scanned.where("size(fragments) = 0").select(*inner, F.lit(None).cast(RUNS).alias("runs"))
    both = none.union(some).withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))
    out = T.StructType([*both.schema.fields, T.StructField("collapsed", T.StringType())])
    return both.mapInArrow(_collapse(place, out.names), out).toDF(*names, "runs", "collapsed")
