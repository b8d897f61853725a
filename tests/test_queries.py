import json

import numpy as np
import pytest

import __spark_entry__ as entry
from check_queries import database, differences, schema_differences
from scoreloom.operators.cluster import sweep_clusters
from scoreloom.plans import archetypes
from scoreloom.plans.staging import stage
from scoreloom.sources import customers

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql_twin(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toArrow()
    want = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert schema_differences(got, want) == []
    assert differences(got.to_pandas(), want.to_pandas()) == []


@pytest.fixture(scope="module")
def clustered(spark):
    with pytest.MonkeyPatch.context() as patch:
        # Every k fitted once instead of ten times.
        patch.setattr(archetypes, "sweep_clusters", lambda *a, **o: sweep_clusters(*a, **{**o, "restarts": 1}))
        return {n: entry.queries()[n](spark, FOLDER).toPandas() for n in ("cluster_scores", "cluster_profiles", "kmeans_sweep", "ml_metadata")}


def rounded(x):
    return np.rint(x * 10) / 10


def test_cluster_ids_follow_the_mean_composite(clustered):
    scores = clustered["cluster_scores"]
    means = scores.dropna(subset=["cluster_id"]).groupby("cluster_id").account_score_pca.mean()
    assert list(means.index) == list(range(len(means))) and means.is_monotonic_increasing


def test_every_customer_is_in_the_nearest_cluster(clustered):
    scores = clustered["cluster_scores"].dropna(subset=["cluster_id"])
    x = scores[["fulfilment_score", "commercial_score", "credit_score"]]
    z = ((x - x.mean()) / x.std(ddof=0)).to_numpy()
    ids = scores.cluster_id.to_numpy().astype(int)
    centres = np.stack([z[ids == c].mean(axis=0) for c in range(ids.max() + 1)])
    distances = ((z[:, None] - centres[None]) ** 2).sum(-1)
    # The fit stops when its centres hardly move, so a point on the border may lag by as much.
    assert (distances[np.arange(len(ids)), ids] <= distances.min(axis=1) + 0.05).all()


def test_profiles_equal_a_plain_group_by(clustered):
    scores = clustered["cluster_scores"].dropna(subset=["cluster_id"])
    profiles = clustered["cluster_profiles"].sort_values(["cluster_id", "page"])
    for c, rows in scores.groupby("cluster_id"):
        mine = profiles[profiles.cluster_id == c]
        assert ", ".join(mine.customers) == ", ".join(sorted(rows.customer))
        assert (mine.n_customers == len(rows)).all()
        for slug in ("fulfilment", "commercial", "credit"):
            np.testing.assert_allclose(mine[f"avg_{slug}"], rounded(rows[f"{slug}_score"].mean()))
        assert (rows.archetype == mine.archetype.iloc[0]).all()


def test_the_sweep_chooses_the_best_k(clustered):
    sweep = clustered["kmeans_sweep"].sort_values(["silhouette", "k"], ascending=[False, True])
    assert sorted(sweep.k) == [2, 3, 4, 5, 6] and list(sweep.chosen) == [True] + 4 * [False]


def test_the_record_equals_its_parts(spark, clustered):
    record = clustered["ml_metadata"].iloc[0]
    pca, clustering = json.loads(record.pca), json.loads(record.clustering)
    weights = entry.queries()["pca_weights"](spark, FOLDER).toPandas()
    assert pca["derived_weights"] == dict(zip(weights.pillar, weights.weight_text))
    sweep = clustered["kmeans_sweep"].set_index("k")
    assert clustering["optimal_k"] == sweep.index[sweep.chosen][0]
    assert clustering["silhouette_scores"] == {str(k): s for k, s in sweep.silhouette.items()}
    assert sum(a["n_customers"] for a in clustering["archetypes"]) == clustered["cluster_scores"].cluster_id.notna().sum()
    metrics = entry.queries()["normalised_metrics"](spark, FOLDER).toPandas()
    assert record.customers == 150
    assert record.customers_left_out_of_components == metrics.isna().any(axis=1).sum()


def test_ordered_results(spark):
    def columns(name, *names):
        return entry.queries()[name](spark, FOLDER).toPandas()[list(names)]

    board = columns("leaderboard", "position", "account_score")
    assert board.position.tolist() == list(range(150, 0, -1))
    assert board.account_score.dropna().is_monotonic_increasing
    assert columns("weight_comparison", "score_delta").score_delta.dropna().is_monotonic_decreasing
    assert columns("pillar_breakdown", "account_score").account_score.dropna().is_monotonic_decreasing


def test_entity_metrics_read_lines_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(customers, "stage", lambda df, name: plans.append(plan(df)) or stage(df, name))
    plans.append(plan(customers.read_customer_entities(spark, FOLDER)))
    assert sum(p.count("lineitem.parquet") for p in plans) == 1
    assert not any("Expand" in p for p in plans)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_sql_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 150
