"""Search and archive: plain versions and odd rows; SQL twins of the subpackage's queries."""

import base64
import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from check_queries import database, differences, schema_differences
from scoreloom.functions.literals import small_table
from scoreloom.llm import queries, topk_search
from scoreloom.llm.catalogue import LLM_ORACLE, LLM_QUERIES
from scoreloom.llm.topk_search import top_k
from scoreloom.llm.warc_archive import archive, export_warc, read_archive, rebuilt_digests, record_digests, records
from scoreloom.plans.staging import new_path

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_its_sql_twin(spark, name):
    got = LLM_QUERIES[name](spark, FOLDER).toArrow()
    want = database(FOLDER).sql(LLM_ORACLE[name]).to_arrow_table()
    assert schema_differences(got, want) == []
    assert differences(got.to_pandas(), want.to_pandas()) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES if n != "pipeline") == list(range(1, 14))


def plain_top(vectors, asked, k):
    """``vectors (id, vector)``, every row by itself; ids may repeat or be null."""
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors]
    out = []
    for n, (q, v) in enumerate(whole):
        if q is not None and asked(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for m, (i, w) in enumerate(whole) if m != n)
            out += [(q, place, None if bare else i, -s) for place, (s, bare, i) in enumerate(scores[:k], 1)]
    return Counter(out)


def small_tasks(monkeypatch):
    for name, value in (("LEAST_PIVOTS", 6), ("MOST_PIVOTS", 9), ("BLOCK", 16), ("CHUNK", 4), ("CELLS", 100)):
        monkeypatch.setattr(topk_search, name, value)


@pytest.mark.parametrize("spread", [0.0, 0.05, 1.0])
def test_search_is_exact(spark, monkeypatch, spread):
    small_tasks(monkeypatch)
    rng = random.Random(1)
    centres = [[rng.gauss(0, 3) for _ in range(4)] for _ in range(5)]
    vectors = [(i, [x + rng.gauss(0, spread) for x in centres[i % 5]]) for i in range(160)]  # spread 0: nothing but ties
    got = top_k(small_table(spark, vectors, "vec_id long, embedding array<double>"), "vec_id % 3 = 0", k=7).collect()
    assert Counter(map(tuple, got)) == plain_top(vectors, lambda i: i % 3 == 0, 7)


def test_rows_that_share_an_id_are_candidates_of_their_own(spark, monkeypatch):
    small_tasks(monkeypatch)
    rng = random.Random(2)
    rows = [(0, [1.0]), (1, [2.0]), (1, [3.0]), (None, [9.0]), (None, [3.0]), (0, [1.0])]
    rows += [(rng.randrange(12), [float(rng.randrange(4))]) for _ in range(60)]
    got = top_k(small_table(spark, rows, "vec_id long, embedding array<double>"), "vec_id % 4 = 0", k=5).collect()
    assert Counter(map(tuple, got)) == plain_top(rows, lambda i: i % 4 == 0, 5)


def test_large_components(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [2.0**24, 1.0]), (1, [2.0**23 + 1, 3.0]), (2, [-(2.0**24), 5.0])]  # sums pass 2**53
    assert Counter(map(tuple, top_k(small_table(spark, rows, schema), "vec_id = 0").collect())) == plain_top(rows, lambda i: i == 0, 20)
    for x, said in ((2.0**56, "passes 62 bits"), (2.0**40, "pass 63 bits")):
        with pytest.raises(Exception, match=said):
            top_k(small_table(spark, [(0, [x]), (1, [x])], schema), "vec_id = 0").collect()


def test_clustered_queries_need_few_cells(spark, monkeypatch):
    """The k-th score of the first cell rules the others out."""
    rng = random.Random(3)
    centres = [[rng.gauss(0, 8) for _ in range(6)] for _ in range(64)]
    vectors = [(i, [x + rng.gauss(0, 0.05) for x in centres[i % 64]]) for i in range(6400)]
    sizes = {}
    monkeypatch.setattr(topk_search, "release", lambda *tables: sizes.update({i: t.count() for i, t in enumerate(tables)}))
    top_k(small_table(spark, vectors, "vec_id long, embedding array<double>"), "vec_id % 20 = 0").collect()
    first, later, _ = sizes.values()
    assert first == 320 and later < 10 * first


def test_search_over_odd_vectors(spark):
    rows = [(0, [1.0, 2.0], "x"), (0, [1.0, 2.0], "x"), (1, None, "x"), (2, [None, 1.0], "x"), (3, [float("nan"), 1.0], "x"), (4, [float("inf"), 1.0], "x"),
            (5, [-1.0], "x"), (None, [1.0, 1.0], "x"), (6, [], "x"), (7, [2.5, 0.0], "x")]
    schema = "vec_id long, embedding array<float>, score string"
    got = Counter(map(tuple, top_k(small_table(spark, rows, schema), "vec_id = 0").collect()))
    assert got == plain_top([(0, [1, 2]), (0, [1, 2]), (5, [-1, 0]), (None, [1, 1]), (6, [0, 0]), (7, [2.5, 0])], lambda i: i == 0, 20)
    assert top_k(small_table(spark, rows, schema).where("false"), "vec_id = 0").collect() == []
    assert top_k(small_table(spark, rows, schema), "vec_id = 99").collect() == []


PAGES = [
    (3, "http://a/ b\r\nX: y", "<p>é</p>", 1), (1, None, "<p>é</p>", 1), (2, "u", None, 1), (5, "u", "", 1), (5, "u", "", 1),
    (4, "v", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", 1), (None, "w", "z", 1), (9, "w", "z", 1), (6, "x", "y" * 200_000, 1),
]


def test_archive_round_trip(spark):
    pages = small_table(spark, PAGES, "page_id long, url string, html string, digest int")
    path = new_path(spark, "warc-test")
    archive(pages, path)
    stored = spark.read.parquet(f"{path}/payloads").count()
    assert stored == len({p[2] or "" for p in PAGES})
    back = read_archive(spark, path)
    rows = record_digests(back).collect()
    assert Counter(r.page_id for r in rows) == Counter(p[0] for p in PAGES)
    got = {r.page_id: r for r in rows if r.refers_to != r.page_id or r.page_id is None}  # of a repeated page, its first record
    for page, _, html, _ in PAGES:
        raw = (html or "").encode()
        assert got[page].payload_bytes == len(raw) and got[page].payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode() == got[page].header_digest
    kinds = {p: (r.record_type, r.refers_to) for p, r in got.items()}
    assert kinds[1] == ("response", None) and kinds[3] == ("revisit", 1)
    assert kinds[2] == ("response", None) and kinds[5] == ("revisit", 2)
    assert kinds[None] == ("response", None) and kinds[9] == ("revisit", None)


def test_every_row_is_a_record(spark):
    rows = [(None, "u1", None), (None, "u2", ""), (None, "u3", ""), (5, "u", "x"), (5, "v", "x"), (5, "u", "x"), (6, "u", "x"), (7, "w", "y")]
    path = new_path(spark, "warc-test")
    archive(small_table(spark, rows, "page_id long, url string, html string"), path)
    back = read_archive(spark, path).collect()
    heads = [dict(l.split(": ", 1) for l in bytes(r.header).decode().split("\r\n") if ": " in l) for r in back]
    want = sorted((p or 0, u, h or "") for p, u, h in rows)
    assert sorted((r.page_id or 0, h["WARC-Target-URI"], bytes(r.payload).decode()) for r, h in zip(back, heads)) == want
    assert len({h["WARC-Record-ID"] for h in heads}) == len(rows)
    kept = {bytes(r.digest): h["WARC-Record-ID"] for r, h in zip(back, heads) if r.record_type == "response"}
    assert len(kept) == 3 == sum(r.record_type == "response" for r in back)
    assert all(h["WARC-Refers-To"] == kept[bytes(r.digest)] for r, h in zip(back, heads) if r.record_type == "revisit")
    assert len(record_digests(read_archive(spark, path)).collect()) == len(rows)


def test_records_are_valid_warc(spark):
    pages = small_table(spark, [p for p in PAGES if p[0] is not None], "page_id long, url string, html string, digest int")
    path = new_path(spark, "warc-test")
    archive(pages, path)
    back = read_archive(spark, path)
    want = sorted(bytes(r.record) for r in records(back).collect())
    export_warc(back, f"{path}/files")
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/files").collect())
    found = []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and head.count(b"\nX:") == 0
        length = int(next(l for l in head.split(b"\r\n") if l.startswith(b"Content-Length: "))[16:])
        found.append(head + b"\r\n\r\n" + rest[:length] + b"\r\n\r\n")
        assert rest[length : length + 4] == b"\r\n\r\n"
        raw = rest[length + 4 :]
    assert sorted(found) == want


def test_a_changed_payload_stops_the_read(spark):
    path = new_path(spark, "warc-test")
    archive(small_table(spark, PAGES[:2], "page_id long, url string, html string, digest int"), path)
    other = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "CAST('forged' AS binary) AS payload")
    other.write.parquet(f"{path}/2/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/2/headers")
    with pytest.raises(Exception, match="does not fit its digest"):
        read_archive(spark, f"{path}/2").collect()


def test_rebuilt_records_are_read_back(spark, monkeypatch):
    path = new_path(spark, "warc-test")
    archive(small_table(spark, PAGES, "page_id long, url string, html string, digest int"), path)
    back = read_archive(spark, path)
    assert sorted(rebuilt_digests(back).collect(), key=str) == sorted(record_digests(back).collect(), key=str)
    for old, new in (("sha1:", "sha1:A"), ("WARC-Type: re", "WARC-Type: xre")):
        forged = back.selectExpr("page_id", "record_type", "refers_to", f"CAST(replace(CAST(header AS string), '{old}', '{new}') AS binary) AS header", "payload")
        with pytest.raises(Exception, match="does not fit its record"):
            rebuilt_digests(forged).collect()
    longer = back.selectExpr("page_id", "record_type", "refers_to", "CAST(concat(CAST(header AS string), ' ') AS binary) AS header", "payload")
    with pytest.raises(Exception, match="does not fit its record"):
        rebuilt_digests(longer).collect()
    # The query itself reads the headers back.
    monkeypatch.setattr(queries, "read_archive", lambda *a: read_archive(*a).withColumn("header", F.lit(b"none")))
    with pytest.raises(Exception, match="does not fit its record"):
        queries.op10_warc(spark, FOLDER).collect()


def test_empty_archive(spark):
    path = new_path(spark, "warc-test")
    archive(small_table(spark, PAGES, "page_id long, url string, html string, digest int").where("false"), path)
    assert read_archive(spark, path).collect() == []
