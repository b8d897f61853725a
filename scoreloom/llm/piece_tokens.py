"""SentencePiece encoding and decoding by suffix-array matching.

For models of the BPE kind with byte fallback. Texts are concatenated in slices
of bounded size and all of a slice's suffixes are sorted. Every piece is found
among them by binary search, all pieces at once; each occurrence is an edge from
its first to its last character (pieces of one character are looked up by it).
The edges are sorted by position, and the text relaxes along them: from single
characters, the best-scored edge that spans two neighbouring tokens replaces
them, the leftmost first among equals, until none is left. Stretches of a slice
that no piece reaches out of and that are equal, letter by letter, relax once.
Characters without a piece become bytes.

Nothing is kept from slice to slice. The model's file is read on the driver and
its pieces are broadcast (a fixed size); tasks need neither the file nor the
library.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scoreloom.llm.words import mix, powers, text_slices

SPACE = "▁"
INDEX_CHARS = 1 << 20  # of one suffix array
EDGE_ROWS = 1 << 20  # occurrences looked at together
MOST_PAIRED = 1 << 12  # characters whose pairs have a table of their own
LONG_UNIT = 128  # characters from which a stretch relaxes with a heap
_NONE = np.iinfo(np.int32).max
_SEAM = re.compile(f"[^{SPACE}\n](?={SPACE})")  # after it a unit begins
_BASE = 0xA0761D6478BD642F  # odd, hence invertible modulo 2**64


class Pieces:
    """The pieces of a model, as plain values."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        if any(model.is_unused(i) for i in every):
            raise ValueError("unused pieces are not supported")
        self.text = [model.id_to_piece(i) for i in every]
        self.score = [model.get_score(i) for i in every]
        self.byte = {int(self.text[i][1:-1], 16): i for i in every if model.is_byte(i)}
        self.special = frozenset(i for i in every if model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback")
        for probe in ("", " ", "a  b\n\tc", "ﬁ Ａ x \U0001f600", "Hello, world. 1234 unbelievable"):
            if Encoder(self).encode([probe])[0].tolist() != model.encode(probe):
                raise ValueError("the model is not a BPE model with unchanged text and a leading space")


class Encoder:
    """Encodes slices of text; holds the model's pieces and nothing of the texts."""

    def __init__(self, pieces: Pieces):
        # In code point order: neighbours are searched for in the same places.
        known = sorted(((i, t) for i, t in enumerate(pieces.text) if i not in pieces.special), key=lambda p: p[1])
        self.ids = np.array([i for i, _ in known], np.int32)
        self.width = max(len(t) for _, t in known)
        self.length = np.array([len(t) for _, t in known], np.int32)
        self.codes = np.zeros((len(known), self.width), np.int32)
        for row, (_, t) in enumerate(known):
            self.codes[row, : len(t)] = np.frombuffer(t.encode("utf-32-le"), np.uint32)
        order = sorted(range(len(known)), key=lambda r: (-pieces.score[self.ids[r]], r))
        self.rank = np.full(len(pieces.text), _NONE, np.int64)
        # Equal scores rank equal: the leftmost goes first then.
        best = np.array([pieces.score[self.ids[r]] for r in order])
        level = np.concatenate(([0], np.cumsum(best[1:] != best[:-1])))
        self.rank[self.ids[order]] = level
        inside = {(a, b) for _, t in known for a, b in zip(t, t[1:])}
        self.joined = np.sort(np.array([(ord(a) << 21) + ord(b) for a, b in inside], np.int64))
        self.alphabet = np.unique(self.codes[np.arange(self.width) < self.length[:, None]])
        # Whether no piece reaches from a letter to a space behind it, or over the end of a line.
        self.parted = all(a == SPACE for a, b in inside if b == SPACE) and not any("\n" in pair for pair in inside)
        self.byte = np.array([pieces.byte[b] for b in range(256)], np.int32)
        self.letter = np.full(0x110001, -1, np.int32)  # the piece of a single character
        self.letter[self.codes[self.length == 1, 0]] = self.ids[self.length == 1]

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The token ids of every text; none for null and empty ones."""
        rows: list[list[np.ndarray]] = [[] for _ in texts]
        for part in self._slices(texts):
            for owner, ids in zip([o for o, _ in part], self._slice([t for _, t in part])):
                rows[owner].append(ids)
        return [np.concatenate([*row, np.zeros(0, np.int32)]) for row in rows]

    def _slices(self, texts: Sequence[str | None]) -> Iterator[list[tuple[int, str]]]:
        """The texts, marked as the model has it, in slices; a long one is cut where no piece reaches over."""
        part, size = [], 0
        for owner, text in enumerate(texts):
            marked = SPACE + text.replace(" ", SPACE) if text else ""
            at = 0
            while at < len(marked):
                stop = len(marked)
                if stop - at > INDEX_CHARS and self.parted:
                    seam = _SEAM.search(marked, at + INDEX_CHARS)
                    stop = seam.start() + 1 if seam else stop
                part.append((owner, marked[at:stop]))
                size += stop - at
                at = stop
                if size >= INDEX_CHARS:
                    yield part
                    part, size = [], 0
        if part:
            yield part

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        """The tokens of every text of one slice."""
        chars = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        small, codes = self._coded(chars)
        codes[first[1:] - 1] = 0  # nothing matches across the end of a text
        begin, stop, same = self._stretches(chars, codes, small, first)
        spoken = np.zeros(len(chars) + 1, np.int32)
        own = same == np.arange(len(same))
        spoken[begin[own]] += 1
        spoken[stop[own]] -= 1
        spoken = np.cumsum(spoken[:-1]).astype(bool)
        fresh = np.zeros(len(chars), bool)
        fresh[begin] = True
        a, b, piece = self._tokens(chars, spoken, fresh, self._edges(small, codes, spoken))

        stretch = np.searchsorted(begin, a, "right") - 1
        flat, stretch = self._with_bytes(chars[a], piece, stretch)
        count = np.bincount(stretch, minlength=len(begin))
        at = np.cumsum(count) - count
        many = count[same]
        every = flat[np.repeat(at[same] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        ends = np.concatenate(([0], np.cumsum(many)))[np.searchsorted(begin, first)]
        return [every[x:y] for x, y in zip(ends[:-1], ends[1:])]

    def _coded(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters as small numbers in the order of their code points, 0 for what no piece has: of the alphabet, and of ``chars``."""
        here = np.zeros(0x110001, np.int32)
        here[chars] = 1
        present = self.alphabet[here[self.alphabet] == 1]
        here[:] = 0
        here[present] = np.arange(1, len(present) + 1)
        return here, here[chars].astype(np.int64)

    def _joint(self, codes: np.ndarray, small: np.ndarray) -> np.ndarray:
        """Whether some piece holds a character and the next one side by side."""
        most = int(codes.max()) + 1
        left, right = small[self.joined >> 21], small[self.joined & (1 << 21) - 1]
        here = (left > 0) & (right > 0)
        pairs = left[here].astype(np.int64) * most + right[here]
        asked = codes[:-1] * most + codes[1:]
        if most <= MOST_PAIRED:
            table = np.zeros(most * most, bool)
            table[pairs] = True
            return table[asked]
        pairs = np.append(np.sort(pairs), -1)
        return pairs[np.searchsorted(pairs[:-1], asked)] == asked

    def _stretches(self, chars: np.ndarray, codes: np.ndarray, small: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of every stretch that no piece reaches out of, and the first one equal to it."""
        ends = np.append(np.flatnonzero(np.append(True, ~self._joint(codes, small))), len(chars))
        begin, stop = ends[:-1], ends[1:]
        solid = np.ones(len(begin), bool)
        solid[np.searchsorted(begin, first[1:] - 1)] = False  # the separators are no text
        begin, stop = begin[solid], stop[solid]

        up, down = powers(_BASE, len(chars))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(chars.astype(np.uint64) + np.uint64(1)) * up)))
        hashed = (sums[stop] - sums[begin]) * down[begin]
        del up, down, sums
        order = np.argsort(hashed)
        fresh = np.append(True, hashed[order[1:]] != hashed[order[:-1]])[: len(order)]
        same = np.empty(len(order), np.int64)
        same[order] = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        # Hashes only propose; every stretch is compared with the one it is to copy.
        length = stop - begin
        alike = length == length[same]
        copies = np.flatnonzero(alike & (same != np.arange(len(same))))
        many = length[copies]
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        wrong = chars[np.repeat(begin[copies], many) + inside] != chars[np.repeat(begin[same[copies]], many) + inside]
        alike[np.repeat(copies, many)[wrong]] = False
        return begin, stop, np.where(alike, same, np.arange(len(begin)))

    def _edges(self, small: np.ndarray, codes: np.ndarray, spoken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges that begin at ``spoken`` places, sorted by position and length: their keys and pieces."""
        index = SuffixIndex(codes, self.width, int(codes.max()))
        own = small[self.codes]
        usable = (self.length > 1) & ((own > 0) | (np.arange(self.width) >= self.length[:, None])).all(1)
        own[np.arange(self.width) >= self.length[:, None]] = 0
        keys, pieces = [], []
        rows = np.flatnonzero(usable)
        low, high = index.ranges(own[rows].astype(np.int64), self.length[rows])
        rows, low, count = rows[high > low], low[high > low], (high - low)[high > low]
        turn = (np.cumsum(count) - count) // EDGE_ROWS
        cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(rows)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            n = count[x:y]
            at = index.order[np.repeat(low[x:y] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            row = np.repeat(rows[x:y], n)
            row, at = row[spoken[at]], at[spoken[at]]
            keys.append(at * (self.width + 1) + self.length[row])
            pieces.append(self.ids[row])
        key = np.concatenate([*keys, np.zeros(0, np.int64)])
        order = np.argsort(key)
        return key[order], np.concatenate([*pieces, np.zeros(0, np.int32)])[order]

    def _tokens(self, chars: np.ndarray, spoken: np.ndarray, fresh: np.ndarray, edges: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """Start, end and piece (-1 without one) of the tokens of all ``spoken`` places, in order."""
        keys, pieces = edges

        def piece(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            if not len(keys):
                return np.full(len(a), -1)
            key = a * (self.width + 1) + np.minimum(b - a, self.width + 1)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where((keys[at] == key) & (b - a <= self.width), pieces[at], -1)

        def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            found = piece(a, b)
            return np.where(found >= 0, self.rank[found], _NONE)

        start = np.flatnonzero(spoken)
        stop = start + 1
        stretch = np.cumsum(fresh[start]) - 1
        sizes = np.bincount(stretch)
        done = [self._relax_long(start[a:b], rank) for a, b in _spans(sizes) if b - a > LONG_UNIT]
        rest = sizes[stretch] <= LONG_UNIT
        start, stop, stretch = start[rest], stop[rest], stretch[rest]

        # The rank of joining each token with the next of its stretch.
        join = np.full(len(start), _NONE, np.int64)
        pairs = np.flatnonzero(stretch[:-1] == stretch[1:])
        join[pairs] = rank(start[pairs], stop[pairs + 1])
        while len(start):
            first = np.flatnonzero(np.concatenate(([True], stretch[1:] != stretch[:-1])))
            count = np.diff(np.append(first, len(start)))
            least = np.repeat(np.minimum.reduceat(join, first), count)
            over = least == _NONE
            if over.any():
                done.append((start[over], stop[over]))
                start, stop, stretch, join, least = start[~over], stop[~over], stretch[~over], join[~over], least[~over]
                if not len(start):
                    break
            best = np.flatnonzero(join == least)
            best = best[np.concatenate(([True], stretch[best[1:]] != stretch[best[:-1]]))]
            stop[best] = stop[best + 1]
            keep = np.ones(len(start), bool)
            keep[best + 1] = False
            start, stop, stretch, join = start[keep], stop[keep], stretch[keep], join[keep]
            best -= np.arange(len(best))
            join[best] = _NONE
            for left in (best[(best + 1 < len(start))], best[best > 0] - 1):
                left = left[stretch[left] == stretch[left + 1]]
                join[left] = rank(start[left], stop[left + 1])
        begin = np.concatenate([a for a, _ in done]) if done else start
        end = np.concatenate([b for _, b in done]) if done else stop
        order = np.argsort(begin)
        begin, end = begin[order], end[order]
        return begin, end, np.where(end - begin > 1, piece(begin, end), self.letter[chars[begin]])

    def _relax_long(self, start: np.ndarray, rank) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long stretch, with a heap of joins."""
        base, n = int(start[0]), len(start)
        # Ranks by length, so that the heap asks for no edge.
        table = [rank(start, start + width).tolist() for width in range(2, self.width + 1)]
        stop, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n and stop[j] - i <= self.width and (own := table[stop[j] - i - 2][i]) != _NONE:
                heapq.heappush(heap, (own, i, stop[j]))

        for i in range(n - 1):
            offer(i)
        alive = [True] * n
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or stop[j] != end:
                continue  # one of the two has been joined since
            stop[i], after[i], alive[j] = end, after[j], False
            if after[i] < n:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        left = [i for i in range(n) if alive[i]]
        return np.array([base + i for i in left]), np.array([base + stop[i] for i in left])

    def _with_bytes(self, chars: np.ndarray, piece: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens with the bytes of characters that have no piece in their places, and the unit of each."""
        bare = np.flatnonzero(piece < 0)
        c = chars[bare]
        size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        many = np.ones(len(piece), np.int64)
        many[bare] = size
        flat, unit = np.repeat(piece, many), np.repeat(unit, many)
        at = (np.cumsum(many) - many)[bare]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size]
        for k in range(4):
            own = size > k
            bits = c[own] >> (6 * (size[own] - 1 - k))
            flat[at[own] + k] = self.byte[(lead[own] | bits) if k == 0 else 0x80 | bits & 0x3F]
        return flat.astype(np.int32), unit


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of the stretches longer than LONG_UNIT."""
    ends = np.cumsum(sizes)
    for i in np.flatnonzero(sizes > LONG_UNIT).tolist():
        yield int(ends[i] - sizes[i]), int(ends[i])


class SuffixIndex:
    """All suffixes of a row of codes in the order of at least their first ``depth`` codes.

    Prefix doubling: as many codes as fit into 63 bits are compared at once, then
    twice as many by the ranks of two halves, and so on.
    """

    def __init__(self, codes: np.ndarray, depth: int, most: int):
        self.bits = max(1, most.bit_length())
        self.chunk = min(depth, 63 // self.bits)
        key = np.zeros(len(codes), np.int64)
        for j in range(self.chunk):
            key <<= self.bits
            key[: max(len(codes) - j, 0)] |= codes[j:]
        self.keys = []  # of every level, distinct and sorted
        self.scale = len(codes) + 1  # above every rank
        reach = self.chunk
        while True:
            order = np.argsort(key)
            key = key[order]
            fresh = np.append(True, key[1:] != key[:-1])
            self.keys.append(key[fresh])
            if reach >= depth:
                break
            rank = np.empty(len(codes), np.int64)
            rank[order] = np.cumsum(fresh)  # from 1; 0 is past the end
            key = rank * self.scale
            key[: max(len(codes) - reach, 0)] += rank[reach:]
            reach *= 2
        self.order = order
        self.starts = np.append(np.flatnonzero(fresh), len(codes))

    def ranges(self, pieces: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``order`` the suffixes that begin with each piece lie; the rows of ``pieces`` end in zeros."""
        low, high = self._ranks(len(self.keys) - 1, pieces, length)
        return self.starts[low], self.starts[high]

    def _ranks(self, level: int, pieces: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks, from 0, of the distinct beginnings of this level that each piece begins."""
        half = self.chunk << (level - 1) if level else 0
        if not level:
            own = np.zeros((len(pieces), self.chunk), np.int64)
            own[:, : pieces.shape[1]] = pieces[:, : self.chunk]
            low = np.zeros(len(pieces), np.int64)
            for j in range(self.chunk):
                low = (low << self.bits) | own[:, j]
            free = self.bits * (self.chunk - np.minimum(length, self.chunk)).astype(np.int64)
            return np.searchsorted(self.keys[0], low), np.searchsorted(self.keys[0], low | ((1 << free) - 1), "right")
        left = self._ranks(level - 1, pieces[:, :half], np.minimum(length, half))
        long = length > half
        low, high = (left[0] + 1) * self.scale, (left[1] + 1) * self.scale
        if long.any():
            right = self._ranks(level - 1, pieces[long, half:], length[long] - half)
            present = left[1][long] > left[0][long]  # one rank then, as the whole half is given
            low[long] = (left[0][long] + 1) * self.scale + right[0] + 1
            high[long] = np.where(present, (left[0][long] + 1) * self.scale + right[1] + 1, low[long])
        return np.searchsorted(self.keys[level], low), np.searchsorted(self.keys[level], high)


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def _made(docs: DataFrame, made: dict[str, T.DataType]) -> tuple[list[str], T.StructType]:
    """The columns that stay, and the schema of them and of those that are made."""
    names = [c for c in docs.columns if c not in made]
    kinds = [docs.schema[c].dataType for c in names] + list(made.values())
    return names, T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)])


def _spellings(pieces: Pieces) -> list[bytes]:
    """What every id stands for: its byte, nothing, or its text."""
    byte = {i: bytes([b]) for b, i in pieces.byte.items()}
    return [byte.get(i, b"" if i in pieces.special else t.replace(SPACE, " ").encode()) for i, t in enumerate(pieces.text)]


def _text(ids: np.ndarray, spelled: list[bytes]) -> str:
    if len(ids) and ids.min() < 0:
        raise ValueError("a token id below 0")
    return b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", "replace").removeprefix(" ")


def encoded(docs: DataFrame, model: str, column: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids of ``column`` in ``ids``.

    A null text gives null, an empty one no ids. With ``decoded`` a column of that
    name holds the text of these ids, taken from them in the same task, so that a
    round trip passes Python once. Every row is its own; all columns stay, those
    that are called like a new one are replaced.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(_pieces(model))
    names, schema = _made(docs, {ids: T.ArrayType(T.IntegerType()), **({decoded: T.StringType()} if decoded else {})})
    place = names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spelled = Encoder(pieces.value), _spellings(pieces.value)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(place), INDEX_CHARS):
                found = encoder.encode(texts)
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                none = [t is None for t in texts]
                made = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*found, np.zeros(0, np.int32)])), mask=pa.array(none))]
                if decoded:
                    made.append(pa.array([None if n else _text(f, spelled) for f, n in zip(found, none)], pa.string()))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *made], names=schema.names)

    return docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, schema).toDF(*names, ids, *([decoded] if decoded else []))


def decoded(tokens: DataFrame, model: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``tokens`` with the text of their ``ids`` in ``column``.

    Null ids give null. The space that encoding puts in front is taken off;
    control tokens have no text; bytes that are no UTF-8 become U+FFFD; an id
    outside the model raises. All columns stay, one called ``column`` already
    is replaced.
    """
    raw = tokens.sparkSession.sparkContext.broadcast(_spellings(_pieces(model)))
    names, schema = _made(tokens, {column: T.StringType()})
    place = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (row.values for row in batch.column(place))
            texts = [None if r is None else _text(r.to_numpy(zero_copy_only=False), raw.value) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return tokens.select(*[f"`{c}`" for c in names]).mapInArrow(run, schema).toDF(*names, column)
