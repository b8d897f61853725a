"""Plain versions, with sets, dictionaries and loops, of operators that SQL cannot express."""

from __future__ import annotations

import math
import re
import struct
import textwrap
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
import xxhash

from check_queries import differences
from scoreloom.functions.literals import small_table
from scoreloom.llm import language_id, licences, mixing
from scoreloom.llm.ngram_join import similar_components
from scoreloom.llm.oracle import ORACLE
from scoreloom.llm.topk_search import top_k
from scoreloom.plans.staging import stage

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# Language: sets of n-grams in place of filters


def grams(text: str | None) -> list[tuple[int, str]]:
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    marked = " " + "".join(f"{w} " for w in letters.split())
    out = []
    for size in language_id.SIZES:
        for i in range(len(marked) - size + 1):
            gram = marked[i : i + size]
            if " " not in gram[1:-1] and (size > 2 or gram.strip()):
                out.append((size, gram))
    return out


def learned(rows) -> tuple[dict[str, set], Counter]:
    counts, prior = defaultdict(Counter), Counter(lang for _, lang in rows)
    for text, lang in rows:
        counts[lang].update(grams(text))
    share = defaultdict(dict)
    for lang, own in counts.items():
        total = Counter()
        for (size, _), n in own.items():
            total[size] += n
        for gram, n in own.items():
            share[gram][lang] = n / total[gram[0]]
    sets = {lang: set() for lang in counts}
    for gram, own in share.items():
        for lang, s in own.items():
            if s >= language_id.LEAST_SHARE and s >= language_id.LEAST_RATIO * max(own.values()):
                sets[lang].add(gram)
    return sets, prior


def test_languages_like_exact_sets(spark, docs):
    rows = [(r.text, r.lang) for r in docs.collect()]
    train = docs.where("doc_id % 3 <> 1 AND lang IS NOT NULL")
    sets, prior = learned([(r.text, r.lang) for r in train.collect()])
    filters = language_id.learn(train)
    assert filters.languages == sorted(sets) and max(filters.wrong) < 0.01
    found, scores = filters.predict([t for t, _ in rows])
    order = sorted(sets, key=lambda l: (-prior[l], l.encode()))
    for (text, _), lang, score in zip(rows, found, scores):
        own = grams(text)
        hits = {l: sum(g in sets[l] for g in own) for l in order}
        if not own:
            assert (lang, score) == (language_id.UNKNOWN, 0)
            continue
        best = max(order, key=lambda l: hits[l])
        # A filter may hold an n-gram too many, at most as often as its filling makes likely, and some.
        slack = 3 * (max(filters.wrong) * len(own)) ** 0.5 + 2
        assert lang == best or hits[best] - hits[lang] <= slack
        assert abs(score - hits[lang] / len(own)) <= slack / len(own) + 1e-9
    exact = [max(order, key=lambda l: sum(g in sets[l] for g in grams(t))) if grams(t) else language_id.UNKNOWN for t, _ in rows]
    assert sum(a == b for a, b in zip(exact, found)) >= 0.99 * len(rows)


# Mixing: pairs one after the other, with the same coins


def hashed(*values) -> int:
    """Spark's xxhash64 of longs (("i", x): an int), signed; nulls are skipped."""
    seed = 42
    for v in values:
        if v is None:
            continue
        raw = struct.pack("<i", v[1]) if isinstance(v, tuple) else v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def coin(*values) -> float:
    return ((hashed(("i", mixing.SEED), *values) & (1 << 64) - 1) >> 11) * 1.1102230246251565e-16


def words(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(rows) -> dict:
    size = defaultdict(int)
    for _, source, text in rows:
        size[source] += words(text)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for i, s in enumerate(order)}
    want, full = mixing.SHARE_PERCENT * sum(size.values()) / 100, {s for s in size if not size[s]}
    while True:
        free = sum(weight[s] for s in size if s not in full)
        rate = (want - sum(mixing.CAP * size[s] for s in full)) / free if free else 0
        more = {s for s in size if s not in full and rate * weight[s] > mixing.CAP * size[s]}
        if not more:
            return {s: mixing.CAP * size[s] if s in full else rate * weight[s] for s in size}
        full |= more


def plain_mix(rows) -> Counter:
    """``(doc_id, hash of the text, source, target, copies)`` of every row."""
    targets, by = plain_targets(rows), defaultdict(list)
    for doc_id, source, text in rows:
        by[source].append((doc_id, None if text is None else hashed(text), words(text)))
    out = []
    for source, own in by.items():
        total, seen, level = sum(s for _, _, s in own), Counter(), defaultdict(list)
        share = targets[source] / max(total, 1)
        whole, p = int(share), share - int(share)
        blocks = -(-len(own) // mixing.BLOCK)
        for doc_id, txt, size in own:
            txt = 42 if txt is None else txt
            seen[doc_id, txt] += 1
            row = (doc_id, txt, seen[doc_id, txt], size)
            if size == 0 or p == 0:
                out.append((row, source, whole))
            else:
                level[hashed(("i", mixing.SEED + 1), *row) % blocks].append((*row, p))
        most = max(-(-n // mixing.BLOCK) for n in map(len, by.values()))
        while level:
            above = defaultdict(list)
            for block, items in level.items():
                held = None
                for b in sorted(items, key=lambda r: (hashed(("i", mixing.SEED + 2), *r[:3]), r[0] is not None, r[0] or 0, *r[1:])):
                    if held is None:
                        held = b
                        continue
                    (*x, xp), (*y, yp) = held, b
                    up, down = min((1 - xp) * x[3], yp * y[3]), min(xp * x[3], (1 - yp) * y[3])
                    if coin(*x[:3], *y[:3]) * (up + down) < down:
                        xp, yp = (1.0 if up == (1 - xp) * x[3] else xp + up / x[3]), (0.0 if up == yp * y[3] else yp - up / y[3])
                    else:
                        xp, yp = (0.0 if down == xp * x[3] else xp - down / x[3]), (1.0 if down == (1 - yp) * y[3] else yp + down / y[3])
                    left = [(*r, q) for r, q in ((x, xp), (y, yp)) if 0 < q < 1]
                    out += [(tuple(r), source, whole + (q >= 1)) for r, q in ((x, xp), (y, yp)) if not 0 < q < 1]
                    held = left[0] if left else None
                if held is not None:
                    above[block // mixing.BLOCK].append(held)
            if most <= 1:
                out += [(r[:4], source, whole + (coin(*r[:4]) < r[4])) for items in above.values() for r in items]
                break
            level, most = above, -(-most // mixing.BLOCK)
    return Counter((r[0], r[1], source, round(targets[source], 6), copies) for r, source, copies in out)


@pytest.mark.parametrize("block", [64, 5])
def test_mix_like_the_plain_loop(spark, docs, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    rows += [(None, "web", "a b c"), (None, "web", "a b c"), (5, None, "d e"), (5, None, None), (5, "web", ""), rows[3], rows[3]]
    table = small_table(spark, rows, "doc_id long, source string, text string")
    got = Counter((r.doc_id, r.txt, r.source, round(r.target, 6), r.copies) for r in mixing.mixed_copies(table).collect())
    assert got == plain_mix(rows)


# SQL twins over rows that share an id or have none


def twin(name: str, table: str, frame: pd.DataFrame):
    con = duckdb.connect()
    con.register("frame", frame)
    con.execute(f"CREATE TABLE {table} AS SELECT * FROM frame")
    return con.sql(ORACLE[name]).to_df()


def test_join_twin_over_repeated_ids(spark):
    base = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
    rows = [(0, base[0]), (1, base[1]), (1, base[0]), (None, base[0]), (None, "x y"), (None, base[2]), (2, base[2] + " end"), (3, None), (3, ""), (1, base[1]), (None, "x y")]
    got = similar_components(small_table(spark, rows, "doc_id long, text string"), 4, 85).toPandas()
    frame = pd.DataFrame({"doc_id": pd.array([i for i, _ in rows], "Int64"), "text": [t for _, t in rows]})
    assert differences(got, twin("op3_ngram_join", "documents", frame)) == []


def test_search_twin_over_repeated_ids(spark):
    rows = [(i % 40 if i % 7 else None, [float((i * k) % 11 - 5) for k in (1, 3, 5)]) for i in range(120)] + [(20, None), (20, [1.0, None, 2.0])]
    got = top_k(small_table(spark, rows, "vec_id long, embedding array<double>"), "vec_id % 20 = 0").toPandas()
    frame = pd.DataFrame({"vec_id": pd.array([i for i, _ in rows], "Int64"), "embedding": [v for _, v in rows]})
    assert differences(got, twin("op9_topk", "embeddings", frame)) == []


# Licences: every run of lines of every text, with the learned weights


def plain_notices(texts: dict, model) -> set:
    vocabulary = set(re.findall(r"'([^']+)'", model.peculiar))
    templates = defaultdict(list)
    for r in model.grams.collect():
        templates[r.family].append(set(r.grams))
    place = {g: i for i, g in enumerate(model.vectorise.vocabulary)}
    weights, bias = model.weights.coefficientMatrix.toArray(), model.weights.interceptVector.toArray()
    slope, offset = model.calibration.coefficients[0], model.calibration.intercept
    most = max(len(re.findall("[a-z0-9]+", t.lower())) for _, t in licences.TEMPLATES)

    def grams_of(own):
        runs = (own[i : i + n] for n in (1, 2, 3) for i in range(len(own) - n + 1))
        return {" ".join(r) for r in runs if vocabulary & set(r)}

    out = set()
    for doc_id, text in texts.items():
        lines = [re.findall("[a-z0-9]+", l.lower()) for l in text.split("\n")]
        told = [bool(vocabulary & set(l)) for l in lines]
        found = set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                inner = [w for l in lines[i + 1 : j] for w in l]
                if j > i and (not lines[j] or len(inner) > most):
                    break
                if not (told[i] and told[j]):
                    continue
                own = lines[i]
                if j > i:
                    before = [w for l in lines[max(i - 2, 0) : i] for w in l] if i and lines[i - 1] else []
                    after = []
                    for l in lines[j + 1 : j + 3]:
                        if not l:
                            break
                        after += l
                    head = lines[i][-most:] if len(lines[i]) > most else before[-2:] + lines[i]
                    tail = lines[j][:most] if len(lines[j]) > most else lines[j] + after[:2]
                    own = head + inner + tail
                grams = grams_of(own)
                raw = bias.copy()
                for g in grams & place.keys():
                    raw += weights[:, place[g]]
                best = int(raw[1:].argmax())
                probability = 1 / (1 + math.exp(-(slope * (raw[1 + best] - raw[0]) + offset)))
                family = model.families[1 + best]
                share = max(len(t & grams) / len(t) for t in templates[family])
                if probability >= licences.MIN_PROBABILITY and share >= licences.MIN_TEMPLATE_SHARE:
                    found.add((-share, j - i, i, j, family))
        taken = []
        for x in sorted(found):
            if not any(t[2] <= x[3] and x[2] <= t[3] for t in taken):
                taken.append(x)
        out |= {(doc_id, i, j, family, round(-share, 9)) for share, _, i, j, family in taken}
    return out


def test_notices_like_the_plain_version(spark, docs):
    longest = {f: max((t for g, t in licences.TEMPLATES if g == f), key=len) for f, _ in licences.TEMPLATES}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, (family, notice) in enumerate(sorted(longest.items())):
        for j, (mark, width) in enumerate((("", 60), (" * ", 30), ("# ", 12))):
            lines = [mark + l for l in textwrap.wrap(notice, width, break_long_words=False)]
            texts[10_000 + 10 * i + j] = "\n".join(["the rights of the library", *lines, "has a license of its own", "", *lines[1:], "All rights reserved."])
    table = small_table(spark, list(texts.items()), "doc_id long, text string")
    paragraphs = stage(licences._paragraphs(table, licences._peculiar(spark)[1]), "paragraphs")
    model = licences.LicenceModel(spark, paragraphs)
    got = {(r.doc_id, r.line, r["last"], r.family, round(r.template_share, 9)) for r in model.predict(paragraphs).collect()}
    assert len(got) > 60 and got == plain_notices(texts, model)
