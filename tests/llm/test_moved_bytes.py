"""What the n-gram join moves: places of n-grams packed and once, sets and prefixes as few times as a pair needs them."""

import json
import os
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scoreloom.llm import ngram_join
from scoreloom.llm.ngram_join import similar_components
from scoreloom.llm.words import mix

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
FOLDER = "/root/testdata/sf0.01"


class Task:
    get = classmethod(lambda cls: cls)
    partitionId = classmethod(lambda cls: 3)


JOIN = """
import sys
from pyspark.sql import SparkSession
from scoreloom.llm import ngram_join
conf = {"spark.master": "local[4]", "spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": sys.argv[1], "spark.sql.shuffle.partitions": "8",
    "spark.eventLog.compress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}  # the plan of large tables
spark = SparkSession.builder.config(map=conf).getOrCreate()
getattr(ngram_join, sys.argv[3])(spark.read.parquet(sys.argv[2]), 5, 80).write.parquet(sys.argv[4])
spark.stop()
"""


def moved(docs, tmp_path, name):
    """Shuffled bytes over bytes of text, as Spark itself counts them in a session of its own, and the rows of the result."""
    table, out, log = f"{tmp_path}/docs", f"{tmp_path}/out", tmp_path / "log"
    log.mkdir()
    docs.coalesce(1).write.parquet(table)
    done = subprocess.run([sys.executable, "-c", JOIN, f"file://{log}", table, name, out], capture_output=True, text=True, timeout=600, env=os.environ | {"PYTHONPATH": REPO})
    assert done.returncode == 0, done.stderr[-2000:]
    ends = [json.loads(line) for path in log.rglob("*") if path.is_file() for line in path.read_text().splitlines() if '"SparkListenerTaskEnd"' in line]
    size = sum(len(r.text.encode()) for r in docs.select("text").collect() if r.text)
    return sum(e.get("Task Metrics", {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) for e in ends) / size, out


def test_the_join_moves_few_bytes(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    share, out = moved(docs, tmp_path, "similar_components")
    assert spark.read.parquet(out).count() == docs.count()
    assert share < 1.1  # 0.65; 1.76 when arrays went along with pairs


def test_texts_without_a_copy_do_not_move(spark, tmp_path):
    """Texts that share no n-gram with another, but for a few copies: long words, so n-grams are few beside the texts."""
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnop", k=400)) for _ in range(30))) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(5)] + [(7, rows[7][1]), (None, "alone"), (None, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    share, out = moved(docs, tmp_path, "without_similar")
    want = Counter(set(rows[:300])) + Counter([(None, "alone"), (None, None), (9, None)])
    assert Counter(map(tuple, spark.read.parquet(out).collect())) == want
    assert share < 0.3  # 0.07; 1.00 when every text met what goes


def some_places(rng):
    """``id, n, prefix``: n-grams alone, in pairs, in one pack very often, and often only over all packs."""
    alone = iter(rng.sample(range(1 << 60), 4000))
    twice, hot, spread = ([next(alone) for _ in range(n)] for n in (300, 3, 2))
    rows = []
    for i in range(600):
        grams = [next(alone) for _ in range(rng.randrange(5))] + rng.sample(twice, 2)
        grams += [h for h in hot if i % 5 == 0 or h == hot[0]] + (spread if i % 17 == 0 else [])
        rows.append(((i % 7 << 33) + i, len(grams) + 10, grams))
    return rows


@pytest.mark.parametrize("dealt", [150, 1000, 1 << 18])
def test_packed_places_are_those_that_meet(monkeypatch, dealt):
    monkeypatch.setattr(ngram_join, "DEALT", dealt)
    monkeypatch.setattr(ngram_join, "TaskContext", Task)
    rows = some_places(random.Random(4))
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 250]), (pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=["id", "n", "prefix"]) for a in range(0, 600, 250)]
    groups = {}
    for batch in ngram_join._dealt(8)(iter(batches)):
        for r in batch.to_pylist():
            groups.setdefault(r["group"], []).append(r["places"])
    got = [tuple(r.values()) for g, packs in groups.items() for r in ngram_join._met(pa.table({"group": [g] * len(packs), "places": packs})).to_pylist()]

    names = [(int(mix(np.array([g], np.uint64))[0] >> np.uint64(16)), i, n, pos) for i, n, grams in rows for pos, g in enumerate(grams)]
    often = Counter(p[0] for p in names)
    assert Counter(got) == Counter((*p, often[p[0]] > ngram_join.SMALL_BUCKET) for p in names if often[p[0]] > 1)


def test_no_group_gathers_a_hot_gram(monkeypatch):
    monkeypatch.setattr(ngram_join, "DEALT", 1000)
    monkeypatch.setattr(ngram_join, "TaskContext", Task)
    ids, grams = list(range(20_000)), [[7]] * 20_000
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([9] * 20_000, pa.int64()), pa.array(grams, pa.list_(pa.int64()))], names=["id", "n", "prefix"])
    size = Counter()
    for out in ngram_join._dealt(8)(iter([batch])):
        for r in out.to_pylist():
            size[r["group"]] += len(ngram_join._columns_unpacked(r["places"])[0])
    assert max(n for g, n in size.items() if g >= 0) <= 20 and max(size.values()) <= 3000


def test_equal_rows_count_once(spark):
    words = [f"w{i}" for i in range(60)]
    near = [*words[:58], "x", "y"]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (None, " ".join(near)), (3, "alone " * 3)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter((r.doc_id, r.component_id) for r in similar_components(docs, 4, 85).collect())
    assert got == {(1, 1): 30, (2, 1): 30, (None, 1): 30, (3, 3): 30}


def test_a_full_sketch_still_tells_common_grams():
    """Hundreds of n-grams in every counter: one that 90 texts share stands late all the same."""
    rng = np.random.default_rng(2)
    totals = rng.poisson(390, 1 << 16).astype(np.float32)
    totals[:500] += 90
    steps = ngram_join._steps(totals)
    assert np.all(np.diff(steps[np.argsort(totals, kind="stable")].astype(int)) >= 0)  # an order by count
    late = np.quantile(steps, 0.8)
    assert (steps[:500] > late).mean() > 0.99
    assert not ngram_join._steps(np.zeros(8, np.float32)).any()
