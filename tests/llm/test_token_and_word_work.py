"""Byte-level BPE, periodic runs and spelling variants against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row
from pyspark.sql import functions as F

from scoreloom.llm import byte_pairs, period_runs, spelling
from scoreloom.llm.queries import op11_byte_pairs, op12_period_runs, op13_spelling, with_planted_period

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(byte_pairs.read_ranks(RANKS)), special_tokens={})


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


# Byte-level BPE


ODD_TEXTS = ["", None, "   ", "\n\n x", "a" * 5000, "ab" * 3000 + " " * 700, "'ll 'S don't 12345", "é漢字 " * 400, "😀" * 50, "<|endoftext|>", "same", "same"]


def test_byte_pairs_like_the_library(spark, library):
    rng = random.Random(1)
    rows = [*ODD_TEXTS, "".join(rng.choice("abcde ") for _ in range(20_000))]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(rows)], "doc_id int, text string, ids int")
    found = {r.doc_id: r.ids for r in byte_pairs.encoded(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert len(found) == len(rows)
    for i, t in enumerate(rows):
        assert found[i] == (None if t is None else library.encode_ordinary(t))


def test_byte_pairs_round_trip_packed_and_as_lists(spark):
    docs = spark.createDataFrame([(t,) for t in ODD_TEXTS], "text string")
    for packed in (False, True):
        back = byte_pairs.decoded(byte_pairs.encoded(docs, RANKS, public_tokenizers.PATTERN, packed=packed), RANKS)
        for r in back.collect():
            assert r.decoded == (None if r.text is None else r.text.encode())
        once = byte_pairs.encoded(docs, RANKS, public_tokenizers.PATTERN, packed=packed, decoded="back", keep=[])
        assert once.columns == ["ids", "back"] and sorted(map(str, once.collect())) == sorted(str(Row(ids=r.ids, back=r.decoded)) for r in back.collect())
    assert byte_pairs.encoded(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_pairs_take_the_lower_rank_that_a_merge_makes_way_for(tmp_path):
    """Ranks in an order that no training gives: "abc" goes before "ab"; every text against a plain loop."""
    rows = [(bytes([b]), 1000 + b) for b in range(256)] + [(b"bc", 30), (b"abc", 5), (b"ab", 20), (b"aa", 21), (b"aab", 3), (b"cab", 4)]
    merges, rank, rng = byte_pairs.Merges(rows), dict(rows), random.Random(2)

    def plain(word: bytes) -> list[int]:
        parts = [bytes([b]) for b in word]
        while True:
            options = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
            if not options:
                return [rank[p] for p in parts]
            _, i = min(options)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 14))) for _ in range(500)})
    flat, count = merges.encode(words)
    for word, ids in zip(words, np.split(flat, np.cumsum(count)[:-1])):
        assert ids.tolist() == plain(word.encode())


def test_byte_pair_query(spark, library, texts):
    found = {r.doc_id: r for r in op11_byte_pairs(spark, SMALL).collect()}
    assert len(found) == len(texts)
    for doc_id, text in texts:
        ids = library.encode_ordinary(text or "")
        r = found[doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


# Periodic runs


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every run as start, period, length; each period tried over all words."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


def plain_collapse(words: list[str], runs) -> str:
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _random_words(rng: random.Random) -> list[str]:
    letters, out = "abcd"[: rng.randint(1, 4)], []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
        out += (unit * 12)[: rng.randint(1, 12 * len(unit))] if rng.random() < 0.6 else unit
    return out


@pytest.mark.parametrize("cells", [1, 8, 1 << 18])
def test_runs_like_the_plain_version(spark, cells):
    rng = random.Random(cells)
    rows = [None, "", " \n ", "one", "x x x x x", "x x x x x x", "A a A a A a A a", *(" ".join(_random_words(rng)) for _ in range(150))]
    rows += rows[-3:]  # equal rows stay apart
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(rows)], "doc_id int, text string, runs int, row int")
    found = {r.doc_id: r for r in period_runs.periodic_runs(docs, cells=cells).collect()}
    assert len(found) == len(rows)
    for i, t in enumerate(rows):
        words = (t or "").split()
        want = plain_runs(words)
        assert [(r.start, r.period, r.length) for r in found[i].runs] == want
        assert found[i].collapsed == plain_collapse(words, want) and found[i].row == 2
    assert period_runs.periodic_runs(docs.limit(0)).count() == 0


def test_long_runs_take_little_work(spark):
    docs = spark.createDataFrame([("w " * 300_000,), ("a b c d e f g " * 40_000,)], "text string")
    found = sorted((r.runs[0].period, r.runs[0].length, len(r.runs), r.collapsed) for r in period_runs.periodic_runs(docs).collect())
    assert found == [(1, 300_000, 1, "w"), (7, 280_000, 1, "a b c d e f g")]


def test_run_query(spark, texts):
    found = {r.doc_id: r for r in op12_period_runs(spark, SMALL).collect()}
    assert len(found) == len(texts)
    planted = {r.doc_id: r.text for r in with_planted_period(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    for doc_id, text in texts:
        words = [w.decode() for w in period_runs.words_of(text)]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert [w.decode() for w in period_runs.words_of(planted[doc_id])] == words
        r = found[doc_id]
        if len(words) <= 1500:
            runs = plain_runs(words)
            best = max(runs, key=lambda x: (x[2] / x[1], -x[0], -x[1]), default=None)
            lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
            assert r.n_runs == len(runs) and r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
            assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
            assert (r.start, r.period, r.length) == (best or (None, None, None))
            assert r.exponent_milli == (best and 1000 * best[2] // best[1])


# Spelling variants


def _near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words: dict[str, int]) -> dict[str, tuple]:
    out, form = {}, {}
    for w, n in words.items():
        near = [v for v in words if _near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
        out[w] = (n, len(near), form[w], form[w] and words[form[w]])
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] += (root,)
    return out


def _told(df) -> dict[str, tuple]:
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_variants_like_the_plain_version(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([2, 3, 25, 300, 4000]) for _ in range(1500)}
    rows = [*words.items(), ("rare", 1), (None, 9), ("", 9), ("twice", 1), ("twice", 1)]
    df = spark.createDataFrame([(w, n, "x") for w, n in rows], "word string, n long, prefix string")
    assert _told(spelling.spelling_variants(df)) == plain_variants({**words, "twice": 2})
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="U\\+0000"):
        spelling.spelling_variants(spark.createDataFrame([("a\0b", 2)], "word string, n long")).count()


def test_every_letter_in_one_place(spark):
    """As many words as a prefix can have."""
    letters = [chr(c) for c in range(97, 123)] + [chr(c) for c in range(0xC0, 0x100)]
    words = {f"word{c}end": 2 + i for i, c in enumerate(letters)} | {"wordend": 1000, "worddend": 4000}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _told(spelling.spelling_variants(df)) == plain_variants(words)


def test_word_counts_and_the_query(spark, texts):
    import re

    odd = [(1, "Straße STRASSE straSSE ÉTÉSÉTÉ étésété"), (1, "straSSE " * 3), (None, "unnumbered"), (2, None), (3, ""), (3, "short")]

    def counts(rows) -> dict[str, int]:
        out: dict[str, int] = {}
        for doc_id, text in rows:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 7:
                    out[run] = out.get(run, 0) + 1
        return out

    df = spark.createDataFrame(odd, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.word_counts(df, change=spelling.without_a_letter).collect()} == counts(odd)

    kept = {w: n for w, n in counts(texts).items() if n >= 2}
    found = _told(op13_spelling(spark, SMALL))
    assert {w: r[0] for w, r in found.items()} == kept
    some = sorted(kept)[::7]
    for w in some:
        near = [v for v in kept if abs(len(v) - len(w)) < 2 and _near(w, v)]
        assert found[w][1] == len(near)
        best = min(near, key=lambda v: (-kept[v], v), default=None)
        assert found[w][2] == (best if best and kept[best] >= 10 * kept[w] else None)
    assert op13_spelling(spark, SMALL).where(F.col("form_n") < 10 * F.col("n")).count() == 0
