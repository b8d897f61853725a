"""Registries as data, balanced sinks, shared staged tables, sketches."""

import json
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest

from fixture import companies, entities
from scoreloom import run_scorecard
from scoreloom.config import Archetype, Metric, Pillar
from scoreloom.functions.literals import small_table
from scoreloom.operators.metadata import framework_record
from scoreloom.operators.quantiles import exact_quantiles
from scoreloom.operators.sketches import (
    count_error,
    distinct_sketches,
    merged_counts,
    merged_sketches,
    quantile_sketches,
    quantiles_within,
    rank_error,
    sketched_quantiles,
)
from scoreloom.plans import staging
from scoreloom.plans.staging import new_path, release_shared, stage_once
from scoreloom.presets import CUSTOMER, SUSTAINABILITY
from scoreloom.sources.customers import customer_entities, read_customer_entities
from scoreloom.sources.registry import agrees_with_record, checked, from_json, from_tables, problems, registry_tables, to_json
from scoreloom.sources.writers import write_marts, write_table

CARDS = (SUSTAINABILITY, CUSTOMER)


@pytest.mark.parametrize("card", CARDS, ids=lambda c: c.name)
def test_registries_come_back(spark, card):
    assert problems(card) == []
    assert from_json(to_json(card)) == card
    again = from_tables(**registry_tables(spark, card))
    assert replace(again, archetypes=()) == replace(card, archetypes=())
    assert [(a.name, sorted(a.conditions)) for a in again.archetypes] == [(a.name, sorted(a.conditions)) for a in card.archetypes]
    record = framework_record(spark.range(3), card, "2024-01-01")
    assert agrees_with_record(card, record) == []


def test_tables_may_be_stored(spark):
    path = new_path(spark, "registry")
    for name, table in registry_tables(spark, CUSTOMER).items():
        table.write.parquet(f"{path}/{name}")
    card = from_tables(**{name: spark.read.parquet(f"{path}/{name}") for name in ("roles", "pillars", "metrics", "archetypes")})
    assert card.weights == CUSTOMER.weights and card.metrics == CUSTOMER.metrics


def test_a_record_of_other_weights_is_told_apart(spark):
    other = replace(CUSTOMER, pillars=(replace(CUSTOMER.pillars[0], weight=0.5), replace(CUSTOMER.pillars[1], label="Trade"), CUSTOMER.pillars[2]))
    found = agrees_with_record(other, framework_record(spark.range(3), CUSTOMER, "2024-01-01"))
    assert found == ["no pillar 'Trade'", "pillar 'Commercial' is not registered", "pillar 'Fulfilment' weighs 40% there"]


first, *rest = CUSTOMER.metrics


@pytest.mark.parametrize(
    "change, said",
    [
        (dict(pillars=(Pillar("a", "A", 0.5),)), "weights of the pillars add up to 0.5"),
        (dict(pillars=(*CUSTOMER.pillars, CUSTOMER.pillars[0])), "pillar 'fulfilment' stands twice"),
        (dict(pillars=()), "no pillars"),
        (dict(key=""), "no key"),
        (dict(metrics=(replace(first, weight=0.3), *rest)), "weights of pillar 'fulfilment' add up to 1.05"),
        (dict(metrics=(replace(first, weight=float("nan")), *rest)), "the weight of 'ship_lag_days' is nan"),
        (dict(metrics=(replace(first, kind="bonus"), *rest)), "unknown kind 'bonus'"),
        (dict(metrics=(replace(first, pillar="z"), *rest)), "unknown pillar 'z'"),
        (dict(metrics=(replace(first, column="kept_pct"), *rest)), "column 'kept_pct' stands twice"),
        (dict(metrics=tuple(replace(m, cap=0) if m.kind == "penalty" else m for m in CUSTOMER.metrics)), "the cap of 'urgent_orders' is 0"),
        (dict(metrics=tuple(replace(m, log1p=True) if m.kind == "flag" else m for m in CUSTOMER.metrics)), "no logarithm"),
        (dict(archetypes=(Archetype("x", (("size", ">", 1),)),)), "unknown measure 'size'"),
        (dict(archetypes=(Archetype("x", (("credit", "~", 1),)),)), "compares by '~'"),
        (dict(archetypes=(Archetype("x", ()),)), "no condition"),
    ],
)
def test_wrong_registries_are_refused(change, said):
    card = replace(CUSTOMER, **change)
    with pytest.raises(ValueError, match=said):
        checked(card)
    with pytest.raises(ValueError, match=said):
        from_json(to_json(card))


def test_strange_entries_and_missing_columns_are_refused(spark):
    raw = json.loads(to_json(CUSTOMER))
    with pytest.raises(ValueError, match="unknown entries colour"):
        from_json(json.dumps({**raw, "colour": "red"}))
    with pytest.raises(ValueError, match="unknown entries unit"):
        from_json(json.dumps({**raw, "metrics": [{**raw["metrics"][0], "unit": "kg"}]}))
    with pytest.raises(ValueError, match="not a scorecard"):
        from_json(json.dumps({"name": "x"}))
    with pytest.raises(ValueError, match="no column 'exec_pay_ratio'"):
        checked(SUSTAINABILITY, entities(spark, companies()).drop("exec_pay_ratio"))
    assert checked(SUSTAINABILITY, entities(spark, companies())) is SUSTAINABILITY
    assert isinstance(SUSTAINABILITY.metrics[0], Metric)


# Sinks


def files(path, group):
    return [p for p in Path(path, f"g={group}").iterdir() if p.suffix == ".parquet"]


def test_a_large_group_is_dealt_out_and_small_ones_lie_together(spark):
    rows = spark.range(0, 200_000, 1, 16).selectExpr("IF(id % 100 < 90, 'big', concat('s', id % 5)) AS g", "id", "md5(string(id)) AS text")
    path = new_path(spark, "sink")
    # Enough partitions that no small group shares the large one's.
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.shuffle.partitions": "100"}
    before = {k: spark.conf.get(k) for k in settings}
    for values, action in ((settings, True), (before, False)):
        for k, v in values.items():
            spark.conf.set(k, v)
        if action:
            write_table(rows, path, "parquet", "g")
    assert len(files(path, "big")) > 2 and all(len(files(path, f"s{i}")) == 1 for i in range(5))
    back = spark.read.parquet(path)
    assert Counter(back.select("g", "id", "text").collect()) == Counter(rows.collect())


def test_files_have_a_limit_of_rows(spark):
    path = new_path(spark, "sink")
    write_marts({"m": spark.range(1000).selectExpr("'x' AS g", "id"), "n": spark.range(10)}, path, "parquet", "g", 300)
    assert sorted(spark.read.parquet(str(f)).count() for f in files(f"{path}/m", "x")) == [100, 300, 300, 300]
    assert spark.read.parquet(f"{path}/n").count() == 10


def test_marts_by_group(spark):
    path = new_path(spark, "marts")
    master = run_scorecard(entities(spark, companies(30)), SUSTAINABILITY, path, "parquet", "2024-01-01", by_group=True, file_rows=10)
    back = spark.read.parquet(f"{path}/esg_scores_master")
    assert Counter(back.select(master.columns).collect()) == Counter(master.collect())
    assert {p.name for p in Path(path, "esg_metric_detail").iterdir() if p.is_dir()} == {f"sector=S{i}" for i in range(4)}
    assert spark.read.parquet(f"{path}/esg_sector_summary").count() == 4


# Shared staged tables


def test_a_shared_table_is_made_again_when_its_source_changes(spark, tmp_path):
    path, made = str(tmp_path / "t"), []

    def shared():
        return stage_once(spark, [path], lambda: made.append(1) or spark.read.parquet(path), "shared").count()

    spark.range(5).write.parquet(path)
    assert (shared(), shared(), len(made)) == (5, 5, 1)
    spark.range(7).write.mode("append").parquet(path)
    assert (shared(), len(made)) == (12, 2)
    release_shared(spark)
    assert not staging._SHARED
    assert (shared(), len(made)) == (12, 3)
    release_shared(spark)


# Sketches


def test_merged_quartiles_are_within_their_error(spark):
    rows = read_customer_entities(spark, "/root/testdata/sf0.1").select("country", *CUSTOMER.metric_columns[:6]).cache()
    columns = CUSTOMER.metric_columns[:6]
    parts = quantile_sketches(rows, columns, ["country"], 400)
    assert parts.count() == 6 * 25
    found = sketched_quantiles(merged_sketches(parts), (0.25, 0.5, 0.75))
    near = quantiles_within(rows, columns, found, rank_error(400)).collect()
    assert len(near) == 18 and all(r.within for r in near)
    off = found.withColumn("value", found.value * 3 + 100)
    assert not any(r.within for r in quantiles_within(rows, columns, off, rank_error(400)).collect())
    want = {(r.metric, r.prob): r.value for r in exact_quantiles(rows, columns, (0.25, 0.5, 0.75)).collect()}
    got = {(r.metric, r.prob): r.value for r in found.collect()}
    spread = {c: want[c, 0.75] - want[c, 0.25] for c in columns}
    assert all(abs(got[k] - want[k]) <= 0.2 * spread[k[0]] + 1e-9 for k in want)
    rows.unpersist()


def test_sketches_of_columns_without_values(spark):
    rows = small_table(spark, [("a", 1.0, None), ("a", None, None), ("b", float("nan"), None)], "g string, x double, y double")
    parts = quantile_sketches(rows, ["x", "y"], ["g"])
    assert {(r.g, r.metric): r.n for r in parts.collect()} == {("a", "x"): 1, ("a", "y"): 0, ("b", "x"): 0, ("b", "y"): 0}
    assert [tuple(r) for r in sketched_quantiles(merged_sketches(parts), [0.5]).collect()] == [("x", 1, 0.5, 1.0)]
    assert merged_sketches(quantile_sketches(rows.where("false"), ["x"], ["g"])).collect() == []


def test_union_of_count_sketches_is_the_sketch_of_all(spark):
    rows = spark.range(60_000).selectExpr("id % 7 AS day", "id % 20011 AS a", "IF(id % 3 = 0, NULL, string(id % 50)) AS b")
    parts = merged_counts(distinct_sketches(rows, ["a", "b"], ["day"])).collect()
    whole = {r.column: r.distinct_values for r in merged_counts(distinct_sketches(rows, ["a", "b"])).collect()}
    assert {r.column: r.distinct_values for r in parts} == whole
    assert {(r.parts, r.rows) for r in parts} == {(7, 60_000)}
    assert abs(whole["a"] - 20011) <= count_error() * 20011 and whole["b"] == 50


def test_surplus_decimals_are_refused(spark):
    """Values add up in whole units of the stated decimals; further digits raise, they are not rounded away."""
    customer = small_table(spark, [(1, "c", 0, 5.0, "S")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    nation = small_table(spark, [(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int")
    orders = spark.sql("SELECT 7L AS o_orderkey, 1L AS o_custkey, 'P' AS o_orderstatus, 3D AS o_totalprice, timestamp_ntz'2024-01-01' AS o_orderdate, '1-URGENT' AS o_orderpriority")

    def price(values, decimals):
        rows = [(7, 1, 1, v, 0.05, 0.07, "R", "F") for v in values]
        lines = small_table(spark, rows, "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
        lines = lines.selectExpr("*", "timestamp_ntz'2024-01-04' AS l_shipdate")
        return customer_entities(customer, nation, orders, lines, decimals).first().revenue

    assert price([10.01, 99999.99, None, 1.07], 2) == 100011.07
    assert price([10.001, 0.333], 3) == 10.334
    with pytest.raises(Exception, match="l_extendedprice 10.001 has more than 2 decimals"):
        price([10.001], 2)
