"""Words and word shingles of a batch of texts, as 64-bit hashes.

A word is a longest run of characters other than space, tab, line feed, vertical
tab, form feed and carriage return; A-Z count as a-z. All texts of a batch are
hashed together over their UTF-8 bytes, a quarter of a megabyte at a time, so
memory does not follow the length of a text beyond the hashes themselves. A
Python worker outlives its task, so nothing large is kept between calls.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATORS = "\x20\x09-\x0d"
CHUNK_BYTES = 1 << 20
HASH_BYTES = 1 << 18  # hashed together, but for a longer word
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A random value for every byte; A-Z share those of a-z."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=_U)
    values[65:91] = values[97:123]
    return values


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2**64."""
    up, down = np.full(size, base, _U), np.full(size, pow(base, -1, 1 << 64), _U)
    up[:1] = down[:1] = 1
    return np.cumprod(up, out=up), np.cumprod(down, out=down)


@lru_cache(maxsize=1)
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return powers(_BASE, 2 * HASH_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _hash_chunk(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~_SPACE[data]
    step = np.diff(np.concatenate(([0], solid.view(np.int8), [0])))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    up, down = _usual_powers() if len(data) <= 2 * HASH_BYTES else powers(_BASE, len(data))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(_byte_values()[data] * up[: len(data)])))
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the place of each text's first word (one more at the end)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    at, places, hashes = 0, [], []
    while at < len(data):
        stop = min(at + HASH_BYTES, len(data))
        while stop < len(data) and not _SPACE[data[stop]]:  # never cut a word
            stop += 1
        starts, found = _hash_chunk(data[at:stop])
        places.append(starts + at)
        hashes.append(found)
        at = stop
    where = np.concatenate(places) if places else np.zeros(0, np.int64)
    words = np.concatenate(hashes) if hashes else np.zeros(0, _U)
    return words, np.searchsorted(where, begins)


def shingle_sets(texts: Sequence[str | None], k: int) -> list[np.ndarray]:
    """The sorted distinct ``k``-word shingles of every text.

    A text of fewer words has its whole sequence as its one shingle, a text
    without words (or a null) has none.
    """
    words, firsts = word_hashes(texts)
    weights = mix(np.arange(1, k + 1, dtype=_U) * _U(_BASE)) | _U(1)
    n = max(len(words) - k + 1, 0)
    runs = np.zeros(n, _U)
    for j in range(k):
        runs += words[j : j + n] * weights[j]
    runs, out = mix(runs), []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            short = np.sum(words[a:b] * weights[: b - a], dtype=_U) + _U(b - a)
            out.append(mix(np.array([short], _U)))
        else:
            out.append(np.zeros(0, _U))
    return out


def slices(texts: Sequence[str | None], limit: int = CHUNK_BYTES):
    """Ranges of a batch whose texts have about ``limit`` characters together, one text at least."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def text_slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[str | None]]]:
    """The ranges of ``slices`` of a column, and their texts.

    Only the texts of one range are held as Python strings.
    """
    begin, size = 0, 0
    for i, length in enumerate(pc.fill_null(pc.utf8_length(column), 0).to_pylist()):
        size += length
        if size >= limit:
            yield begin, i + 1, column[begin : i + 1].to_pylist()
            begin, size = i + 1, 0
    if begin < len(column):
        yield begin, len(column), column[begin:].to_pylist()
