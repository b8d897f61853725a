"""Byte-level BPE encoding and decoding by replaying the merges over a corpus.

A slice of the corpus (some millions of characters, or one longer text) becomes
the table of its distinct words: matches of a pattern that cuts texts. The bytes
of all words of the table stand in one row, and an inverted index leads from the
token that two neighbours would form to every place where they stand. The merges
are applied in rank order, each at all of its places at once, left to right; only
the touched neighbours get new entries in the index. Where a merge makes way for
one of lower rank, that one goes first, so every word goes through the merges it
would go through alone. The texts then read their tokens off the table.

Nothing outlives its slice, and texts never leave their task: there is no
shuffle. The ranks are read on the driver and broadcast (a fixed size).
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.words import slices

SLICE_CHARS = 1 << 22
MANY = 24  # places of a merge that are handled together
LONG_TEXT = 1 << 20  # characters from which words are not all held at once
_BITS = 21  # of a token id inside a pair


@lru_cache(maxsize=2)
def read_ranks(path: str) -> tuple[tuple[bytes, int], ...]:
    """The ``(token, rank)`` rows of a file of ranks; every single byte must be a token."""
    with open(path, "rb") as lines:
        rows = tuple((base64.b64decode(token), int(rank)) for token, rank in (line.split() for line in lines if line.strip()))
    tokens = {token for token, _ in rows}
    if not all(bytes([b]) in tokens for b in range(256)):
        raise ValueError(f"{path} has no token for some byte")
    if len({rank for _, rank in rows}) != len(rows) or max(rank for _, rank in rows) >> _BITS:
        raise ValueError(f"{path} repeats a rank or has one above {(1 << _BITS) - 1}")
    return rows


class Merges:
    """Ranks by token, and by every pair of tokens that forms a token."""

    def __init__(self, rows: Sequence[tuple[bytes, int]]):
        self.rank = dict(rows)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.pair: dict[int, int] = {}
        for token, rank in rows:
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    self.pair[left << _BITS | right] = rank
        self.pairs = np.array(sorted(self.pair), np.int64)
        self.forms = np.array([self.pair[p] for p in self.pairs.tolist()], np.int32)
        self.length = np.zeros(max(self.rank.values()) + 1, np.int32)
        self.length[list(self.rank.values())] = [len(token) for token, _ in rows]
        self.bytes = np.full((256, 256), -1, np.int32)
        for token, rank in rows:
            if len(token) == 2:
                self.bytes[token[0], token[1]] = rank

    def formed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What neighbouring tokens form; -1 for nothing."""
        if not len(self.pairs):
            return np.full(len(left), -1, np.int32)
        key = left.astype(np.int64) << _BITS | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.forms[at], -1)

    def encode(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of ``words``, one word after the other, and how many each word has."""
        raw = [w.encode() for w in words]
        whole = np.array([self.rank.get(r, -1) for r in raw], np.int32)  # a word that is a token stays whole
        open_ = np.flatnonzero(whole < 0)
        ids, own = _Corpus(self, [raw[i] for i in open_.tolist()]).replayed()
        count = np.ones(len(raw), np.int64)
        count[open_] = own
        flat = np.empty(count.sum(), np.int32)
        inside = np.repeat(whole < 0, count)
        flat[inside], flat[~inside] = ids, whole[whole >= 0]
        return flat, count


class _Corpus:
    """The bytes of some words in one row, a gap after each, and the tokens that cover them.

    ``token`` and ``stop`` of a token stand at its first byte, ``before`` is the
    first byte of the token that ends there; gaps and bytes inside a token have
    the token -1. The index leads from a form to the first bytes of pairs that
    make it up; an entry counts as long as its two tokens still end where the
    form does.
    """

    def __init__(self, merges: Merges, raw: list[bytes]):
        self.merges = merges
        data = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)
        self.gaps = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) - 1
        token = merges.byte[data]
        token[self.gaps] = -1
        forms = np.full(len(data), -1, np.int32)
        forms[:-1] = merges.bytes[data[:-1], data[1:]]
        forms[token < 0] = -1
        forms[self.gaps - 1] = -1
        # Python and numpy look at the same memory.
        self.token, self.stop, self.before = array("i", token.tobytes()), array("i", range(1, len(data) + 1)), array("i", range(-1, len(data) - 1))
        self.tokens, self.stops, self.befores = (np.frombuffer(x, np.int32) for x in (self.token, self.stop, self.before))
        self.index: dict[int, array] = {}
        self.ranks: list[int] = []
        places = np.flatnonzero(forms >= 0)
        self._enter(forms[places], places.astype(np.int32))

    def _enter(self, forms: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(forms)
        forms, places = forms[order], places[order]
        cuts = np.flatnonzero(np.diff(forms, prepend=-1)).tolist()
        for a, b, form in zip(cuts, [*cuts[1:], len(forms)], forms[cuts].tolist()):
            if form not in self.index:
                self.index[form] = array("i")
                heapq.heappush(self.ranks, form)
            self.index[form].frombytes(places[a:b].tobytes())

    def replayed(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words in order, and how many each has."""
        while self.ranks:
            rank = heapq.heappop(self.ranks)
            here = self.index.pop(rank)
            if len(here) < MANY or not self._merge_all(rank, np.sort(np.frombuffer(here, np.int32))):
                self._merge_each(rank, sorted(here))
        solid = np.flatnonzero(self.tokens >= 0)
        return self.tokens[solid], np.diff(np.searchsorted(solid, self.gaps), prepend=0)

    def _merge_all(self, rank: int, here: np.ndarray) -> bool:
        """Merge at all places at once; undone and False where that makes way for a lower rank."""
        tokens, stops, befores, length = self.tokens, self.stops, self.befores, int(self.merges.length[rank])
        here = here[(tokens[here] >= 0) & (np.diff(here, prepend=-1) > 0)]
        middle = stops[here]
        valid = stops[middle] == here + length
        valid &= tokens[middle] >= 0
        here, middle = here[valid], middle[valid]
        if len(here) > 1:
            # Of pairs that share a token every other one is merged, from the left.
            shares = np.append(False, middle[:-1] == here[1:])
            place = np.arange(len(here))
            free = (place - np.maximum.accumulate(np.where(shares, 0, place))) % 2 == 0
            here, middle = here[free], middle[free]
        end = here + length
        old = tokens[here], tokens[middle], stops[here], befores[end]
        tokens[here], tokens[middle], stops[here], befores[end] = rank, -1, end, here
        left = befores[here]
        left, lefts = left[left >= 0], here[left >= 0]
        forms = np.concatenate((self.merges.formed(tokens[left], tokens[lefts]), self.merges.formed(tokens[here], tokens[end])))
        if ((forms < rank) & (forms >= 0)).any():
            tokens[here], tokens[middle], stops[here], befores[end] = old
            return False
        made = forms >= 0
        self._enter(forms[made], np.concatenate((left, here))[made])
        return True

    def _merge_each(self, rank: int, here: list[int]) -> None:
        """Merge one place after the other, and stop where that makes way for a lower rank."""
        token, stop, before, pair, index = self.token, self.stop, self.before, self.merges.pair, self.index
        length = int(self.merges.length[rank])
        for n, i in enumerate(here):
            j = stop[i]
            end = i + length
            if token[i] < 0 or token[j] < 0 or stop[j] != end:
                continue  # one of the two has been merged since
            token[i], token[j], stop[i], before[end] = rank, -1, end, i
            lowest = rank
            for at, key in ((before[i], None), (i, rank << _BITS | token[end])):
                if key is None:
                    if at < 0 or token[at] < 0:
                        continue
                    key = token[at] << _BITS | rank
                elif token[end] < 0:
                    continue
                form = pair.get(key)
                if form is not None:
                    if form not in index:
                        index[form] = array("i")
                        heapq.heappush(self.ranks, form)
                    index[form].append(at)
                    lowest = min(lowest, form)
            if lowest < rank and n + 1 < len(here):
                if rank not in index:
                    index[rank] = array("i")
                    heapq.heappush(self.ranks, rank)
                index[rank].extend(array("i", here[n + 1 :]))
                break


def encode_texts(merges: Merges, pattern, texts: Sequence[str | None]) -> list[np.ndarray]:
    """The tokens of every text of a slice; none for null and empty ones."""
    seen: defaultdict[str, int] = defaultdict()
    seen.default_factory = seen.__len__  # a new word gets the next number
    rows = []
    for text in texts:
        row = array("i")
        if text:
            cut = pattern.findall(text) if len(text) < LONG_TEXT else (m.group() for m in pattern.finditer(text))
            row.extend(map(seen.__getitem__, cut))
        rows.append(np.frombuffer(row, np.int32) if row else np.zeros(0, np.int32))
    flat, count = merges.encode(list(seen))
    begin = np.cumsum(count) - count
    out = []
    for row in rows:
        n = count[row]
        out.append(flat[np.repeat(begin[row] - np.cumsum(n) + n, n) + np.arange(n.sum())])
    return out


_MERGES: dict[int, Merges] = {}


def _merges(rows) -> Merges:
    """The pairs of the model, made once a worker process: a fixed size."""
    if rows.id not in _MERGES:
        _MERGES.clear()
        _MERGES[rows.id] = Merges(rows.value)
    return _MERGES[rows.id]


class _Shared:
    """A broadcast with a name that workers can tell models apart by."""

    def __init__(self, df: DataFrame, path: str):
        self.rows = df.sparkSession.sparkContext.broadcast(read_ranks(path))
        self.id = path

    @property
    def value(self):
        return self.rows.value


def _kept(df: DataFrame, made: dict[str, T.DataType], keep: Sequence[str] | None) -> tuple[list[str], T.StructType]:
    """The columns that stay, and the schema of them and of those that are made."""
    names = [c for c in (df.columns if keep is None else keep) if c not in made]
    kinds = [df.schema[c].dataType for c in names] + list(made.values())
    return names, T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)])


def _ids(found: list[np.ndarray], none: list[bool], packed: bool) -> pa.Array:
    if packed:
        return pa.array([None if n else f.astype("<u4").tobytes() for f, n in zip(found, none)], pa.binary())
    ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*found, np.zeros(0, np.int32)])), mask=pa.array(none))


def _bytes(rows: pa.Array, token: dict[int, bytes], packed: bool) -> pa.Array:
    out = []
    for row in rows.to_pylist():
        own = np.frombuffer(row, "<u4").tolist() if packed and row else row
        out.append(None if row is None else b"".join([token[i] for i in own or ()]))
    return pa.array(out, pa.binary())


def encoded(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    column: str = "text",
    ids: str = "ids",
    packed: bool = False,
    decoded: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with the token ids of ``column`` in ``ids``.

    ``ranks`` names a file of tokens with ranks, ``pattern`` is the regular
    expression whose matches are encoded apart; special tokens are ordinary
    text. Ids are an array, or with ``packed`` their bytes as little-endian
    unsigned 32-bit integers. With ``decoded`` a column of that name holds the
    bytes that these ids decode to, taken from the ids in the same task, so that a
    round trip passes Python once. A null text gives null, an empty one no ids.
    Every row is its own; all columns stay, or those of ``keep``; those called
    like a new one are replaced; columns that share a name raise.
    """
    shared = _Shared(docs, ranks)
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    names, schema = _kept(docs, {ids: kind, **({decoded: T.BinaryType()} if decoded else {})}, keep)
    # The text comes last, so that it need not go back where it is not kept.
    given = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{column}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        merges, cut = _merges(shared), regex.compile(pattern)
        token = {rank: raw for raw, rank in shared.value} if decoded else {}
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            for a, b in slices(texts, SLICE_CHARS):
                made = [_ids(encode_texts(merges, cut, texts[a:b]), [t is None for t in texts[a:b]], packed)]
                if decoded:
                    made.append(_bytes(made[0], token, packed))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:-1]), *made], names=schema.names)

    return given.mapInArrow(run, schema).toDF(*names, ids, *([decoded] if decoded else []))


def decoded(tokens: DataFrame, ranks: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes of their ``ids`` (an array or packed) in ``column``.

    Null ids give null, no ids no bytes; an id that the file does not have
    raises. All columns stay, one called ``column`` already is replaced.
    """
    shared = _Shared(tokens, ranks)
    names, schema = _kept(tokens, {column: T.BinaryType()}, None)
    place = names.index(ids)
    packed = isinstance(tokens.schema[ids].dataType, T.BinaryType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: raw for raw, rank in shared.value}
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _bytes(batch.column(place), token, packed)], names=schema.names)

    return tokens.select(*[f"`{c}`" for c in names]).mapInArrow(run, schema).toDF(*names, column)
