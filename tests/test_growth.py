"""Plans and passes that must not change with the size of the tables."""

import math
import os

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from scoreloom.functions.literals import small_table
from scoreloom.functions.lloyd import centre_sums
from scoreloom.operators import cluster
from scoreloom.plans.staging import stage
from scoreloom.sources import customers

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entities_are_joined_alike_at_every_size(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(customers, "stage", lambda df, name: plans.append(plan(df)) or stage(df, name))
    plans.append(plan(customers.read_customer_entities(spark, FOLDER)))
    lines, rest = plans
    assert "SortMergeJoin" in lines and "BroadcastExchange" not in lines
    # Keys are counted in the shares they are dealt to; only counts move again.
    moves = [line for line in rest.splitlines() if "Exchange hashpartitioning" in line]
    dealt = [line for line in moves if "l_partkey" in line or "l_suppkey" in line]
    assert len(dealt) == 2 and all("pmod(hash(" in line and "ENSURE_REQUIREMENTS" not in line for line in dealt)


def test_shares_count_every_key_once(spark):
    """A customer with most lines, repeated keys and null ones."""
    rng = np.random.default_rng(3)
    lines = [(int(o), int(p) if p else None, int(s)) for o, p, s in zip(rng.integers(0, 40, 4000) ** 2 // 60, rng.integers(0, 90, 4000), rng.integers(0, 300, 4000))]
    table = small_table(spark, lines, "l_orderkey long, l_partkey long, l_suppkey long").selectExpr(
        "*", "timestamp_ntz'2024-01-04' AS l_shipdate", "1D AS l_extendedprice", "0.1D AS l_discount", "0D AS l_tax",
        "IF(l_partkey > 40, 'F', NULL) AS l_linestatus", "IF(l_partkey > 60, 'R', IF(l_partkey > 20, 'N', NULL)) AS l_returnflag",
    )
    orders = spark.range(30).selectExpr(
        "id AS o_orderkey", "id % 5 AS o_custkey", "'P' AS o_orderstatus", "3D AS o_totalprice", "timestamp_ntz'2024-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"
    )
    customer = spark.range(5).selectExpr("id AS c_custkey", "'c' AS c_name", "0 AS c_nationkey", "5D AS c_acctbal", "'S' AS c_mktsegment")
    nation = small_table(spark, [(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int")
    got = {r.customer_key: r for r in customers.customer_entities(customer, nation, orders, table).collect()}
    for c in range(5):
        mine = [line for line in lines if line[0] < 30 and line[0] % 5 == c]
        parts = [p for _, p, _ in mine]
        known = [p for p in parts if p is not None]
        assert got[c].supplier_breadth == len({s for _, _, s in mine})
        assert got[c].part_diversity_pct == 100.0 * len(set(known)) / len(mine)
        assert got[c].fulfilled_pct == 100.0 * sum(p > 40 for p in known) / len(mine)
        assert got[c].return_pct == 100.0 * sum(p > 60 for p in known) / len(mine)
        assert got[c].kept_pct == 100.0 * sum(20 < p <= 60 for p in known) / len(mine)
        assert got[c].ship_lag_days == 3


def test_lines_move_as_two_whole_numbers(spark):
    """Nothing but the key, two numbers and what does not fit them; every value comes back as it was."""
    day = "timestamp_ntz'{}'".format
    fine = (7, 9, 84197.04, 0.07, 0.02, day("1996-09-13"), "'F'", "'R'")
    odd = [
        (2**30 - 1, 2**24 - 1, 1e9, 1.27, 1.27, day("2149-06-06"), "'O'", "'N'"),
        (2**30, 9, 1.1, 0.07, 0.02, day("1996-09-13"), "'F'", "'R'"),
        (2**62, 2**24, 1.1, 0.07, 0.02, day("1996-09-13"), "'F'", "'R'"),
        (-1, -9, 1.1, 0.07, 0.02, day("1996-09-13"), "'F'", "'N'"),
        (7, 9, -84197.04, -0.01, 1.28, day("1969-12-31"), "'F'", "'A'"),
        (7, 9, 10.001, 0.333, 0.1 + 0.2, day("2149-06-07"), "NULL", "NULL"),
        (7, 9, 1e300, 0.0, 0.0, day("9999-12-31"), "'O'", "'A'"),
        *((*fine[:i], "NULL", *fine[i + 1 :]) for i in range(len(fine))),
    ]
    names = ("l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_linestatus", "l_returnflag")
    types = {**dict.fromkeys(names[:2], "bigint"), **dict.fromkeys(names[2:5], "double"), "l_shipdate": "timestamp_ntz"}
    cells = [", ".join(f"CAST({f'{v!r}D' if isinstance(v, float) else v} AS {types.get(n, 'string')}) AS {n}" for n, v in zip(names, r)) for r in (fine, *odd)]
    rows = [f"SELECT {i}L AS l_orderkey, {c}" for i, c in enumerate(cells)]
    lines = stage(spark.sql(" UNION ALL ".join(rows)), "lines")
    moved = {r.l_orderkey: r for r in spark.sql(customers._NARROW_LINES, lineitem=lines).collect()}
    # The ordinary one, the largest values, and those with no flag.
    assert sorted(i for i, r in moved.items() if r.whole is None) == [0, 1, 14, 15]
    assert all((r.money is None) == (r.terms is None) == (r.whole is not None) for r in moved.values())
    orders = spark.range(len(rows)).selectExpr("id AS o_orderkey", "id AS o_custkey", "timestamp_ntz'1995-01-01' AS o_orderdate")
    joined = spark.sql(customers._OWNED_LINES, lineitem=lines, orders=orders)
    want = lines.selectExpr(
        "l_orderkey AS o_custkey", "l_partkey", "l_suppkey", "datediff(l_shipdate, date'1995-01-01') AS lag",
        "tinyint(IF(l_linestatus = 'F', 1, 0) + CASE l_returnflag WHEN 'N' THEN 2 WHEN 'R' THEN 4 ELSE 0 END) AS flags", "l_extendedprice", "l_discount", "l_tax",
    )
    assert joined.dtypes == want.dtypes
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, want.collect()))


def test_the_written_lines_are_packed_tightly(spark):
    rows = spark.range(20_000).selectExpr("id % 997 AS a", "id * 7919 % 20011 AS b").repartition(1)
    size = {}
    for name in ("owned-lines", "other"):
        table = stage(rows, name)
        assert table.count() == 20_000 and sorted(table.limit(3).columns) == ["a", "b"]
        size[name] = sum(os.path.getsize(f.removeprefix("file://")) for f in table.inputFiles())
    assert all(f.endswith(".zstd.parquet") for f in stage(rows, "owned-lines").inputFiles())
    assert size["owned-lines"] < 0.9 * size["other"]


def test_only_busy_customers_are_dealt(spark):
    rest = plan(customers.read_customer_entities(spark, FOLDER.replace("0.001", "0.1")))
    # 15,000 customers with about 40 lines each: none of them has a thousandth.
    dealt = [line for line in rest.splitlines() if "Exchange hashpartitioning" in line and "pmod(hash(" in line]
    assert len(dealt) == 2 and all("key#" in line and "), 1)" in line and " IN" not in line for line in dealt)
    busy = spark.range(20_000).selectExpr("IF(id % 10 = 3, 7L, 100 + id % 1900) AS o_custkey")
    assert customers._shares(busy) == "IF(o_custkey IN (7), 8, 1)"
    assert customers._shares(spark.range(0).selectExpr("id AS o_custkey")) == "1"


def test_sums_of_many_sets_of_centres():
    rng = np.random.default_rng(1)
    x, w = rng.normal(size=(3000, 3)).round(1), rng.integers(1, 4, 3000).astype(float)
    sets = [rng.normal(size=(k, 3)) for k in (3, 2, 3, 5)] + [np.zeros((2, 3))]  # the last: equally near, the first counts
    got = centre_sums([(x[:1700], w[:1700]), (x[1700:], w[1700:])], sets)
    found = {(f, c): i for i, (f, c) in enumerate(zip(got["fit"], got["cluster"]))}
    assert len(found) == sum(map(len, sets))
    for f, centres in enumerate(sets):
        far = ((x[:, None] - centres[None]) ** 2).sum(-1)
        own = far.argmin(axis=1)
        for c in range(len(centres)):
            mine, i = own == c, found[f, c]
            assert got["weight"][i] == w[mine].sum()
            assert got["cost"][i] == pytest.approx((far.min(axis=1) * w)[mine].sum())
            np.testing.assert_allclose([got[f"s{d}"][i] for d in range(3)], (x * w[:, None])[mine].sum(axis=0), atol=1e-9)


def test_restarts_share_their_passes(spark, monkeypatch):
    """All restarts are followed, yet MLlib moves the centres of the best one only; it is the one MLlib itself finds."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 8, (9, 3))[rng.integers(0, 9, 900)] + rng.normal(0, 1.5, (900, 3))
    points = small_table(spark, [([float(v) for v in p], float(1 + i % 3)) for i, p in enumerate(x)], "features array<double>, weight double")
    points = points.withColumn("features", array_to_vector("features")).coalesce(1).cache()
    made, real = [], cluster.KMeans
    monkeypatch.setattr(cluster, "KMeans", lambda **given: made.append((given["k"], given["seed"], given["maxIter"])) or real(**given))
    fits = cluster.best_fits(points, (4, 6), restarts=8)
    assert sorted(k for k, _, rounds in made if rounds) == [4, 6]
    assert sorted((k, s) for k, s, rounds in made if not rounds) == [(k, 42 + i) for k in (4, 6) for i in range(8)]
    place = cluster.vector_to_array("features")
    dealt = points.repartition(1, place).sortWithinPartitions(place).cache()
    for f in fits:
        costs = [
            real(k=f.k, seed=42 + i, maxIter=300, tol=math.sqrt(cluster.MOVE / f.k), initSteps=5, weightCol="weight").fit(dealt).summary.trainingCost
            for i in range(8)
        ]
        assert max(costs) > min(costs) * 1.01
        assert f.cost == pytest.approx(min(costs), rel=1e-9)
    dealt.unpersist()
    points.unpersist()


def test_ordinary_lines_leave_the_high_bytes_of_one_number_empty(spark):
    lines = customers.nulls_for_nan(spark.read.parquet(f"{FOLDER}/lineitem.parquet"))
    moved = spark.sql(customers._NARROW_LINES, lineitem=lines).selectExpr("count(*) AS n", "count(whole) AS whole", "min(terms) AS lo", "max(terms) AS hi").first()
    assert moved.n == lines.count() and moved.whole == 0
    assert 0 <= moved.lo and moved.hi < 1 << 32


def test_prices_are_written_in_cents(spark, monkeypatch):
    """Prices that have no more than two decimals, are not negative and fit an int; the others as they are."""
    prices = [0.29, 0.0, 84197.04, 2e7, 20000000.01, 1e9, -3.25, 10.001, None, -0.0]
    cell = lambda p: "double(NULL)" if p is None else f"{p!r}D"
    rows = [
        f"SELECT {i}L AS l_orderkey, 1L AS l_partkey, 2L AS l_suppkey, timestamp_ntz'1996-09-13' AS l_shipdate, {cell(p)} AS l_extendedprice, "
        "0.1D AS l_discount, 0D AS l_tax, 'F' AS l_linestatus, 'R' AS l_returnflag"
        for i, p in enumerate(prices)
    ]
    orders = spark.range(len(prices)).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'P' AS o_orderstatus", "3D AS o_totalprice", "timestamp_ntz'1996-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"
    )
    customer = spark.range(len(prices)).selectExpr("id AS c_custkey", "'c' AS c_name", "0 AS c_nationkey", "5D AS c_acctbal", "'S' AS c_mktsegment")
    nation = small_table(spark, [(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int")
    written = []
    monkeypatch.setattr(customers, "stage", lambda df, name: written.append(stage(df, name)) or written[-1])
    got = customers.customer_entities(customer, nation, orders, stage(spark.sql(" UNION ALL ".join(rows)), "lines"), decimals=3)
    assert {r.customer_key: r.revenue for r in got.collect()} == dict(enumerate(prices))
    kept = {r.o_custkey: (r.cents, r.price) for r in written[0].collect()}
    assert dict(written[0].dtypes)["cents"] == "int"
    assert {i: c for i, (c, _) in kept.items() if c is not None} == {0: 29, 1: 0, 2: 8419704, 3: 2_000_000_000, 9: 0}
    assert all(p is None if c is not None else p == prices[i] for i, (c, p) in kept.items())
