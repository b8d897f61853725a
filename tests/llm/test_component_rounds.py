"""Rounds of the components: their results, and how much of the driver they ask for."""

import random

import pytest

from scoreloom.llm import components as module
from scoreloom.llm.components import components
from scoreloom.plans.staging import stage


def plain(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def frame(spark, edges):
    return spark.createDataFrame(edges, "u long, v long")


@pytest.fixture
def rounds(monkeypatch):
    seen = []
    one = module._towards_least
    monkeypatch.setattr(module, "_towards_least", lambda edges: seen.append(1) or one(edges))
    return seen


def some_graphs():
    rng = random.Random(3)
    chain = list(range(60))
    rng.shuffle(chain)
    hub = [(1000, i) for i in range(300)]
    sparse = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    dense = [(rng.randrange(-40, 40), rng.randrange(-40, 40)) for _ in range(600)]
    return [[], [(7, 7)], list(zip(chain, chain[1:])), hub + hub[:5] + [(a, b) for b, a in hub[:5]], sparse, dense + [(1 << 62, -(1 << 62))]]


@pytest.mark.parametrize("at", range(6))
def test_components_match_a_plain_version(spark, at):
    edges = some_graphs()[at]
    rows = components(frame(spark, edges)).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.component for r in rows} == plain(edges)


def test_stars_need_no_round(spark, rounds):
    edges = [(i, i % 5) for i in range(5, 60)]
    assert {r.node: r.component for r in components(frame(spark, edges)).collect()} == plain(edges)
    assert not rounds


def test_no_round_only_finds_that_nothing_moves(spark, rounds):
    edges = [(1, 0), (2, 1)]
    assert {r.node: r.component for r in components(frame(spark, edges)).collect()} == {0: 0, 1: 0, 2: 0}
    assert len(rounds) == 1


def test_a_round_takes_few_shuffles(spark):
    edges = stage(frame(spark, [(2, 1), (3, 2)]), "edges")
    plan = module._towards_least(edges)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange") < 8
