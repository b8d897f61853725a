"""States of batches against the state of all rows."""

import numpy as np
import pandas as pd
import pytest

from fixture import companies, entities
from scoreloom.operators import state
from scoreloom.operators.normalise import find_bounds, scaling_input
from scoreloom.operators.rank import group_percentiles
from scoreloom.operators.score import bands, composite, pillar_scores
from scoreloom.plans.growing import add_batch, run_batch
from scoreloom.plans.staging import new_path
from scoreloom.presets import SUSTAINABILITY as CARD

COLUMNS = [f"{s}_{CARD.group}_pct" for s in CARD.all_scores]


@pytest.fixture(scope="module")
def frame():
    df = companies(90, seed=11)
    df.loc[[3, 40], "sector"] = None
    df.loc[[5, 60], "water_usage_intensity"] = np.nan
    # The first rows hold every bound, so that later ones move none.
    for i, m in enumerate(CARD.scaled):
        df.loc[2 * i, m.column], df.loc[2 * i + 1, m.column] = df[m.column].min(), df[m.column].max()
    return df


def rows(df):
    return df.toPandas().sort_values(df.columns[:3]).reset_index(drop=True)


def parts(spark, df):
    return [entities(spark, df.iloc[a:b]) for a, b in ((0, 40), (40, 45), (45, 90))]


def test_merged_state_equals_the_state_of_all(spark, frame):
    first, *later = parts(spark, frame)
    merged = state.batch_state(first, CARD)
    for batch in later:
        merged = state.merge_states(merged, state.batch_state(batch, CARD, merged.basis))
    whole = state.batch_state(entities(spark, frame), CARD)
    pd.testing.assert_frame_equal(rows(state.state_figures(merged, 9)), rows(state.state_figures(whole, 9)))
    pd.testing.assert_frame_equal(rows(merged.counts), rows(whole.counts))
    assert state.moved_bounds(merged).isEmpty()


def test_moments_equal_plain_ones(spark, frame):
    figures = {(r.metric, r.form): r for r in state.state_figures(state.batch_state(entities(spark, frame), CARD)).collect()}
    for m in CARD.metrics:
        x, r = frame[m.column].dropna().astype(float), figures[m.column, "linear"]
        assert (r.n, r.lo, r.hi) == (len(x), round(x.min(), 6), round(x.max(), 6))
        assert abs(r["mean"] - x.mean()) < 1e-5 and abs(r.dev - x.std(ddof=0)) < 1e-5
    assert {m for m, form in figures if form == "scaled"} == {m.column for m in CARD.scaled}


def test_large_values_lose_no_digit(spark):
    """Squared deviations, not squares: values of 10^9 with a spread of 1."""
    frame = companies(40)
    frame["water_usage_intensity"] = 1e9 + np.arange(40) % 3
    a, b = (state.metric_moments(entities(spark, part), CARD) for part in (frame.iloc[:7], frame.iloc[7:]))
    got = state.merge_moments(a.unionByName(b)).where("metric = 'water_usage_intensity' AND form = 'linear'").first()
    assert abs(np.sqrt(got.squares / got.n) - frame.water_usage_intensity.std(ddof=0)) < 1e-6


def test_percentiles_from_the_state(spark, frame):
    first, *later = parts(spark, frame)
    grown = add_batch(first, CARD)
    for batch in later:
        grown = add_batch(batch, CARD, grown.state)
    scored = bands(composite(pillar_scores(entities(spark, frame), CARD), CARD), CARD)
    want = group_percentiles(scored, CARD.group, CARD.all_scores).toPandas().set_index("ticker")
    # The last batch, ranked within everything so far.
    got = grown.scores.toPandas().set_index("ticker")
    assert len(got) == 45
    pd.testing.assert_frame_equal(got[COLUMNS], want.loc[got.index, COLUMNS])
    pd.testing.assert_frame_equal(got[CARD.all_scores], want.loc[got.index, CARD.all_scores])
    assert got.loc[got.sector.isna(), COLUMNS].isna().all().all()


def test_a_batch_that_moves_a_bound_says_so(spark, frame):
    outlier = frame.iloc[45:].copy()
    outlier.loc[outlier.index[0], "waste_recycling_pct"] = 500
    first = state.batch_state(entities(spark, frame.iloc[:45]), CARD)
    merged = state.merge_states(first, state.batch_state(entities(spark, outlier), CARD, first.basis))
    moved = state.moved_bounds(merged).collect()
    assert [(r.metric, r.new_hi, r.lo == r.new_lo) for r in moved] == [("waste_recycling_pct", 500.0, True)]
    # Scores anew, under the bounds that the moments of both give.
    every = entities(spark, pd.concat([frame.iloc[:45], outlier]))
    again = state.rebase(merged, every, CARD)
    assert state.moved_bounds(again).isEmpty()
    pd.testing.assert_frame_equal(rows(again.counts), rows(state.batch_state(every, CARD).counts))
    assert again.bounds() == find_bounds(every, {m.column: scaling_input(m) for m in CARD.scaled})


def test_states_of_other_bounds_do_not_merge(spark, frame):
    a, b = (state.batch_state(entities(spark, frame.iloc[i : i + 10]), CARD) for i in (0, 60))
    with pytest.raises(ValueError, match="other bounds of"):
        state.merge_states(a, b)


def test_stored_states(spark, frame):
    first, second, third = parts(spark, frame)
    paths = [new_path(spark, "state") for _ in range(3)]
    run_batch(first, CARD, paths[0])
    run_batch(second, CARD, paths[1], paths[0])
    grown = run_batch(third, CARD, paths[2], paths[1])
    loaded = state.load_state(spark, paths[2])
    pd.testing.assert_frame_equal(rows(loaded.counts), rows(grown.state.counts))
    pd.testing.assert_frame_equal(rows(loaded.counts), rows(state.batch_state(entities(spark, frame), CARD).counts))
    assert loaded.bounds() == grown.state.bounds()
    with pytest.raises(Exception, match="already exists"):
        state.save_state(loaded, paths[2])


def test_empty_and_constant_batches(spark, frame):
    whole = state.batch_state(entities(spark, frame), CARD)
    nothing = state.batch_state(entities(spark, frame.iloc[:0]), CARD, whole.basis)
    assert nothing.counts.isEmpty() and {r.n for r in nothing.metrics.collect()} == {0}
    both = state.merge_states(whole, nothing)
    pd.testing.assert_frame_equal(rows(state.state_figures(both, 9)), rows(state.state_figures(whole, 9)))
    pd.testing.assert_frame_equal(rows(both.counts), rows(whole.counts))
    given = state.given_basis(spark, {m.column: (0.0, 100.0) for m in CARD.scaled})
    assert state.batch_state(entities(spark, frame), CARD, given).bounds()["exec_pay_ratio"] == (0.0, 100.0)
