import numpy as np
import pandas as pd
import pytest
from fixture import CARD, WORKED, WORKED_COLUMNS, WORKED_SCORES, companies, entities, halfeven

from scoreloom import build_scorecard, score_entities
from scoreloom.functions.literals import small_table
from scoreloom.operators import marts
from scoreloom.operators.normalise import find_bounds, min_max_01, min_max_100, normalise_01
from scoreloom.operators.score import compare_weights, equal_weight_pillars


@pytest.fixture(scope="module")
def raw():
    df = companies()
    df.loc[3, "exec_pay_ratio"] = None
    df.loc[5, "sector"] = None
    return df


@pytest.fixture(scope="module")
def master(spark, raw):
    return build_scorecard(entities(spark, raw), CARD).cache()


def scale(spark, values, rule, invert=False):
    df = small_table(spark, list(enumerate(values)), "i int, x double")
    bounds = find_bounds(df, {"x": "x"})["x"]
    return [r[0] for r in df.orderBy("i").selectExpr(rule("x", bounds, invert)).collect()]


def test_constant_and_empty_columns(spark):
    assert scale(spark, [4.0, None, 4.0], min_max_100) == [50.0, 50.0, 50.0]
    assert scale(spark, [4.0, None, 4.0], min_max_100, invert=True) == [50.0, 50.0, 50.0]
    assert scale(spark, [None, None], min_max_100) == [None, None]
    assert scale(spark, [4.0, None], min_max_01) == [0.5, 0.5]
    assert scale(spark, [None, None], min_max_01) == [0.5, 0.5]


def test_min_max(spark):
    assert scale(spark, [-2.0, 0.0, 2.0, None], min_max_100) == [0.0, 50.0, 100.0, None]
    assert scale(spark, [-2.0, 0.0, 2.0, None], min_max_01, invert=True) == [1.0, 0.5, 0.0, None]


def test_scores_worked_out_by_hand(spark):
    got = build_scorecard(entities(spark, pd.DataFrame(WORKED, columns=WORKED_COLUMNS)), CARD)
    for row in got.collect():
        *scores, percentile = WORKED_SCORES[row["ticker"]]
        assert [row[s] for s in ("env_score", "soc_score", "gov_score", "esg_score")] == scores
        assert {row[f"{s}_sector_pct"] for s in CARD.all_scores} == {percentile}


def test_columns_and_percentiles(master, raw):
    got = master.toPandas()
    assert list(got.columns[:21]) == list(raw.columns)
    for s in CARD.all_scores:
        want = halfeven(got.groupby("sector")[s].rank(pct=True) * 100)
        np.testing.assert_array_equal(got[f"{s}_sector_pct"].to_numpy(float), want.to_numpy(float))


def test_null_rows(master):
    row = master.where("ticker = 'T003'").first()
    assert row["gov_score"] is None and row["esg_score"] is None and row["esg_rating"] is None
    assert row["esg_band"] == "Critical" and row["esg_score_sector_pct"] is None
    assert row["env_score"] is not None
    lost = master.where("ticker = 'T005'").first()
    assert lost["esg_score"] is not None and lost["esg_score_sector_pct"] is None


def test_empty_universe(spark, raw):
    none = entities(spark, raw).where("false")
    assert build_scorecard(none, CARD).count() == 0
    assert marts.metric_detail(none, CARD).count() == 0


def test_same_result_for_any_partitioning(spark, raw, master):
    again = build_scorecard(entities(spark, raw).repartition(7), CARD)
    assert again.exceptAll(master).count() == 0 and master.exceptAll(again).count() == 0


def test_long_and_detail(spark, raw, master):
    long = marts.scores_long(master, CARD)
    assert long.count() == 3 * len(raw)
    assert {r[0] for r in long.select("pillar").distinct().collect()} == {"Environmental", "Social", "Governance"}
    detail = marts.metric_detail(entities(spark, raw), CARD).toPandas()
    assert len(detail) == 12 * len(raw)
    one = detail[detail.metric_name == "Community Investment ($M)"].set_index("ticker").sort_index()
    x = raw.set_index("ticker").sort_index()["community_investment_mn"]
    np.testing.assert_array_equal(
        one.normalised_score, halfeven((x - x.min()) / (x.max() - x.min()) * 100)
    )
    assert not one.lower_is_better.any()


def test_group_summary_ties_go_to_the_smallest_key(spark):
    rows = [
        ("K2", "Two", "G", 50.0), ("K1", "One", "G", 50.0), ("K3", "Three", "G", None),
        ("K4", "Four", "H", None), ("K5", "Five", None, 99.0),
    ]
    df = spark.createDataFrame(rows, "ticker string, company string, sector string, esg_score double")
    for p in CARD.pillars:
        df = df.withColumn(p.score, df.esg_score)
    got = {r["sector"]: r for r in marts.group_summary(df, CARD).collect()}
    assert set(got) == {"G", "H"}
    assert got["G"]["top_company"] == "One" and got["G"]["company_count"] == 3 and got["G"]["avg_esg"] == 50.0
    assert got["H"]["top_company"] is None and got["H"]["top_esg"] is None


def test_chart_marts(master, raw):
    board = marts.leaderboard(master, CARD).orderBy("position").toPandas()
    assert board.position.tolist() == list(range(1, len(raw) + 1))
    ordered = board.esg_score.dropna()
    assert ordered.is_monotonic_decreasing and board.esg_score.isna().iloc[-1]
    assert set(board.colour) <= {"#2ecc71", "#f39c12", "#e74c3c", "#8e44ad"}

    bins = marts.score_histogram(master, CARD).toPandas()
    assert bins.entities.sum() == len(raw) - 1

    radar = marts.extremes_radar(master, CARD).toPandas()
    assert len(radar) == 6 * 4 and set(radar.side) == {"top", "bottom"}

    heat = marts.group_heatmap(master, CARD).toPandas()
    assert heat["Composite ESG"].is_monotonic_decreasing

    box = marts.group_box_stats(master, CARD).toPandas().set_index("sector")
    want = master.toPandas().groupby("sector").esg_score.quantile([0.25, 0.5, 0.75]).unstack()
    np.testing.assert_allclose(box.loc[want.index, ["q25", "q50", "q75"]], want)

    points = marts.quadrants(master, CARD).toPandas()
    assert set(points.quadrant) <= {"Environmental and Social", "Environmental only", "Social only", "Neither"}
    bars = marts.pillar_breakdown(master, CARD).toPandas()
    assert len(bars) == 3 * len(raw) and set(bars.colour) == {"#27ae60", "#2980b9", "#8e44ad"}


def test_histogram_puts_100_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (9.9,), (10.0,), (100.0,), (None,)], "esg_score double")
    got = {r["bin"]: r["entities"] for r in marts.score_histogram(df, CARD).collect()}
    assert got == {0: 2, 1: 1, 9: 1}


def test_equal_weights_skip_nulls(spark, raw):
    df = entities(spark, raw)
    got = equal_weight_pillars(df, CARD).toPandas().set_index("ticker").sort_index()
    norm = normalise_01(df, CARD, ["ticker"]).toPandas().set_index("ticker").sort_index()
    for p in CARD.pillars:
        want = halfeven(norm[[m.column for m in CARD.of_pillar(p.slug)]].mean(axis=1) * 100)
        np.testing.assert_array_equal(got[p.score], want)
    assert not pd.isna(got.loc["T003", "gov_score"])
    both = compare_weights(equal_weight_pillars(df, CARD), CARD, CARD.weights).toPandas()
    assert (both.score_delta == 0).all()


def test_scores_stay_in_range(spark, raw):
    got = score_entities(entities(spark, raw), CARD).toPandas()[CARD.all_scores]
    assert got.min().min() >= 0 and got.max().max() <= 100
