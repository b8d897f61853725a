"""Bins, boxes and densities against plain versions."""

import math

import numpy as np
import pytest

from scoreloom.functions.literals import small_table
from scoreloom.operators import distribution as dist
from scoreloom.presets import CUSTOMER as CARD

SCHEMA = "customer_key long, customer string, segment string, account_score double"


def scored(spark, rows):
    return small_table(spark, [(i, f"c{i}", g, s) for i, (g, s) in enumerate(rows)], SCHEMA)


def some_rows(n=900, seed=3):
    rng = np.random.default_rng(seed)
    groups = rng.choice(["A", "B", "C"], n, p=[0.7, 0.25, 0.05])
    return [(str(g), float(np.rint(min(100, max(0, rng.normal(50, 14 if g == "A" else 6))) * 10) / 10)) for g in groups]


@pytest.mark.parametrize(
    "lo, hi, step",
    [(0, 100, 20), (0, 99.9, 10), (0, 0.09, 0.01), (-7, 12, 5), (-7, 11, 2), (3, 3, 1), (-1e9, 1e9, 5e8), (1e-7, 9e-7, 1e-7), (19.9, 20.1, 0.05), (0, 1, 0.2)],
)
def test_steps(lo, hi, step):
    assert dist.bin_step(lo, hi) == step
    assert math.floor(hi / step) - math.floor(lo / step) < dist.MOST_BINS


def test_no_range_needs_more_than_ten_bins():
    rng = np.random.default_rng(1)
    for _ in range(3000):
        lo = rng.normal() * 10.0 ** rng.integers(-6, 9)
        hi = lo + abs(rng.normal()) * 10.0 ** rng.integers(-6, 9)
        step = dist.bin_step(lo, hi)
        assert math.floor(hi / step) - math.floor(lo / step) < 10
        mantissa = step / 10.0 ** math.floor(math.log10(step) + 1e-9)
        assert min(abs(mantissa - m) for m in (1, 2, 5)) < 1e-6


def test_steps_refuse_what_has_no_bins():
    for bad in ((0, math.inf), (-math.inf, 0), (math.nan, 1)):
        with pytest.raises(ValueError, match="no bins"):
            dist.bin_step(*bad)
    with pytest.raises(ValueError, match="two bins"):
        dist.bin_step(0, 1, 1)


def test_bins_hold_every_value_once(spark):
    rows = [(-3.5, 7.0, None), (-0.1, 7.0, None), (0.0, 7.0, None), (4.0, 7.0, None), (math.nan, 7.0, None), (None, None, None)]
    got = dist.binned_counts(small_table(spark, rows, "a double, same double, none double"), ["a", "same", "none"]).collect()
    assert {r.measure for r in got} == {"a", "same"}
    bins = sorted((r.low, r.high, r.entities) for r in got if r.measure == "a")
    assert [b[2] for b in bins] == [1, 0, 0, 1, 1, 0, 0, 0, 1] and bins[0][0] == -4.0 and all(h - l == 1 for l, h, _ in bins)
    assert [(r.bin, r.low, r.high, r.entities) for r in got if r.measure == "same"] == [(0, 7.0, 8.0, 5)]
    assert dist.binned_counts(small_table(spark, [], "a double"), ["a"]).collect() == []


def test_fences_and_whiskers(spark):
    rows = [("A", s) for s in (1.0, 40.0, 42.0, 44.0, 46.0, 48.0, 99.9)] + [("B", 5.0), (None, 50.0), ("C", None)]
    got = {r.segment: r for r in dist.box_fences(scored(spark, rows), CARD).collect()}
    assert set(got) == {"A", "B"}
    a = got["A"]
    assert (a.q25, a.q50, a.q75, a.low_fence, a.high_fence) == (41.0, 44.0, 47.0, 32.0, 56.0)
    assert (a.low_whisker, a.high_whisker, a.outliers, a.entities) == (40.0, 48.0, 2, 7)
    assert (got["B"].low_whisker, got["B"].high_whisker, got["B"].outliers) == (5.0, 5.0, 0)


def test_points_come_in_pages(spark):
    rows = some_rows()
    table = scored(spark, rows)
    fences = {r.segment: (r.low_fence, r.high_fence) for r in dist.box_fences(table, CARD).collect()}
    got = dist.box_points(table, CARD, page_rows=50).collect()
    assert len(got) == len(rows)
    for g in "ABC":
        own = sorted((r for r in got if r.segment == g), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, len(own) + 1)) and [r.page for r in own] == [i // 50 for i in range(len(own))]
        assert [(r.account_score, r.customer_key) for r in own] == sorted((s, i) for i, (h, s) in enumerate(rows) if h == g)
        low, high = fences[g]
        assert all(r.outlier == (not low <= r.account_score <= high) for r in own)


def test_density_like_a_plain_kernel(spark):
    rows = some_rows() + [("lone", 30.0), ("flat", 60.0), ("flat", 60.0), (None, 10.0), ("A", None)]
    got = dist.score_density(scored(spark, rows), CARD).collect()
    curves = {}
    for r in got:
        curves.setdefault((r.whole, r.segment), {})[r.point] = (r.density, r.bandwidth)
    assert set(curves) == {(True, None), (False, "A"), (False, "B"), (False, "C")}
    for (whole, g), curve in curves.items():
        x = np.array([s for h, s in rows if s is not None and (whole or h == g)])
        h = 1.06 * x.std(ddof=1) * len(x) ** -0.2
        assert sorted(curve) == list(range(101))
        for at, (density, bandwidth) in curve.items():
            want = np.exp(-0.5 * ((at - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
            assert abs(density - want) < 1e-8 and abs(bandwidth - h) < 1e-8
    # Nearly all of the mass is on the grid.
    assert all(abs(sum(d for d, _ in c.values()) - 1) < 0.02 for c in curves.values())


def test_counts_meet_the_grid_not_rows(spark):
    table = scored(spark, some_rows()).union(scored(spark, some_rows()))
    plan = dist.score_density(table, CARD)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_universe(spark):
    none = scored(spark, [])
    for f in (dist.box_fences, dist.box_points, dist.score_density):
        assert f(none, CARD).collect() == []
