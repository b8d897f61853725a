"""What a Python worker takes and keeps: it outlives its task, and four may stand beside an executor's heap."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from scoreloom.llm import ngram_join, words
from scoreloom.llm.piece_tokens import Encoder, Pieces
from scoreloom.llm.queries import PIECES

MB = 1 << 20


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    known = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(2, 9, 5000)]
    return [" ".join(known[i] for i in rng.integers(0, 5000, n)) for n in [*rng.integers(10, 3000, 300), 90_000]]


def measured(work):
    """MB that stay after ``work``, and most that it held at a time."""
    gc.collect()
    tracemalloc.start()
    try:
        work()
        gc.collect()
        now, most = tracemalloc.get_traced_memory()
        return now / MB, most / MB
    finally:
        tracemalloc.stop()


def test_word_hashes_keep_little(texts):
    words.shingle_sets(texts[:1], 5)
    kept, most = measured(lambda: [None for _ in words.shingle_sets(texts, 5)])
    assert kept < 10 and most < 45


def test_profiles_take_a_counter_table_once(texts, monkeypatch):
    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = classmethod(lambda cls: 3)

    monkeypatch.setattr(ngram_join, "TaskContext", Task)
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["doc_id", "txt", "text"])
    out = []
    kept, most = measured(lambda: out.extend(b.num_rows for b in ngram_join._profiles(5)(iter([batch]))))
    assert sum(out) == len(texts) + ngram_join.SKETCH_PARTS
    assert kept < 10 and most < 60


def test_encoder_keeps_little(texts):
    encoder = Encoder(Pieces(PIECES))
    encoder.encode(["a few words first"])
    kept, most = measured(lambda: [None for _ in encoder.encode(texts)])
    assert kept < 10


def test_text_slices_are_those_of_slices(texts):
    odd = [None, "", "ä" * 40, "x" * 200, None, "𝄞é" * 30, *texts[:50], ""]
    for limit in (1, 50, 1000, 10**9):
        plain = list(words.slices(odd, limit))
        cut = list(words.text_slices(pa.array(odd), limit))
        assert [c[:2] for c in cut] == plain and [t for c in cut for t in c[2]] == odd
    assert list(words.text_slices(pa.array([], pa.string()))) == []
