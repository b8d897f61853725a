import numpy as np
import pandas as pd
import pytest
from fixture import CARD, companies, entities

from scoreloom import enhance_scorecard
from scoreloom.functions.literals import small_table
from scoreloom.functions.tiles import distances
from scoreloom.operators import cluster
from scoreloom.operators.features import (
    assemble,
    component_table,
    dominant_pillars,
    fit_components,
    loadings_table,
    standardise,
    weight_table,
)
from scoreloom.operators.normalise import normalise_01
from scoreloom.operators.profiles import cluster_profiles, member_pages
from scoreloom.plans.archetypes import derive_weights


def silhouette(x: np.ndarray, labels: np.ndarray) -> float:
    """Brute force over all pairs."""
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def points(spark, x, labels):
    rows = [(list(map(float, p)), *map(int, np.atleast_1d(l))) for p, l in zip(x, labels)]
    names = [f"l{i}" for i in range(len(rows[0]) - 1)]
    df = spark.createDataFrame(rows, "features array<double>, " + ", ".join(f"{n} int" for n in names))
    return cluster.weigh_points(df, ["features"], names), names


@pytest.mark.parametrize("dims", [3, 12])
def test_silhouette_matches_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(cluster, "_TILE_ROWS", 64)  # several tiles
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, dims)).round(1)
    x[:100] = x[0]  # copies: a third of all rows at one point
    labels = np.stack([rng.integers(0, 3, 300), rng.integers(0, 5, 300)], axis=1)
    labels[:100] = labels[0]
    labels[299, 0] = 9  # alone in its cluster
    df, names = points(spark, x, labels)
    got = {r.sweep: r.silhouette for r in cluster.euclidean_silhouette(df, names).collect()}
    for i, name in enumerate(names):
        assert got[name] == pytest.approx(silhouette(x, labels[:, i]), abs=1e-6)


def test_silhouette_of_one_cluster_is_null(spark):
    df, names = points(spark, np.eye(3), [0, 0, 0])
    assert cluster.euclidean_silhouette(df, names).first()["silhouette"] is None


def test_squared_silhouette_counts_every_copy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 2)).round(1)
    x[:20] = x[0]
    labels = rng.integers(0, 3, 60)
    labels[:20] = labels[0]
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    want = []
    for i, own in enumerate(labels):
        a = d[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        want.append((b - a) / max(a, b))
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(k=labels)
    rows = assemble(spark.createDataFrame(pdf), ["a", "b"])
    assert cluster.squared_silhouette(rows, "k") == pytest.approx(np.mean(want), abs=1e-9)


def test_distances_agree():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(20, 16)), rng.normal(size=(30, 16))
    want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    np.testing.assert_allclose(distances(a, b), want, atol=1e-9)
    np.testing.assert_allclose(distances(a[:, :4], b[:, :4]), np.sqrt(((a[:, None, :4] - b[None, :, :4]) ** 2).sum(-1)))


def test_standardise(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 4.0], "b": [3.0, 3.0, 3.0]})
    got = standardise(spark.createDataFrame(pdf), ["a", "b"], []).toPandas()
    np.testing.assert_allclose(got.a, (pdf.a - pdf.a.mean()) / pdf.a.std(ddof=0))
    assert (got.b == 0).all()


def test_components_match_the_correlation_matrix(spark):
    df = entities(spark, companies())
    normalised = normalise_01(df, CARD, []).toPandas()
    model = fit_components(normalise_01(df, CARD, []), CARD)
    values, vectors = np.linalg.eigh(np.corrcoef(normalised.T))
    np.testing.assert_allclose(model.explainedVariance.toArray(), values[::-1][:3] / values.sum(), rtol=1e-9)
    for j in range(3):
        np.testing.assert_allclose(np.abs(model.pc.toArray()[:, j]), np.abs(vectors[:, -1 - j]), atol=1e-8)
    assert loadings_table(model, CARD, spark).count() == 45


def test_weights(spark):
    affinity = small_table(
        spark, [("PC1", "Social", 0.3), ("PC1", "Governance", 0.3), ("PC1", "Environmental", 0.1)],
        "component string, pillar string, affinity double",
    )
    assert dominant_pillars(affinity).first()["dominant_pillar"] == "Governance"

    variance = small_table(spark, [("PC1", 0.6), ("PC2", 0.15), ("PC3", 0.05)], "component string, explained double")
    loadings = small_table(
        spark,
        [(c, p, p, 0.9 if p == best else -0.1)
         for c, best in (("PC1", "Environmental"), ("PC2", "Social"), ("PC3", "Environmental"))
         for p in ("Environmental", "Social", "Governance")],
        "component string, metric string, pillar string, loading double",
    )
    got = {r.slug: (r.weight, r.weight_text) for r in weight_table(component_table(variance, loadings), CARD).collect()}
    assert got["env"][0] == pytest.approx(0.8125) and got["env"][1] == "81.2%"
    assert got["soc"][0] == pytest.approx(0.1875) and got["gov"] == (0.0, "0.0%")


def test_incomplete_rows_raise_or_are_skipped(spark):
    raw = companies()
    raw.loc[0, "exec_pay_ratio"] = None
    with pytest.raises(Exception, match="(?i)null|invalid"):
        derive_weights(entities(spark, raw), CARD)
    assert sum(derive_weights(entities(spark, raw), CARD, "skip").by_slug().values()) == pytest.approx(1.0)


def test_best_k_is_chosen_on_rounded_silhouettes(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0, 0], [10, 0, 0], [0, 10, 0]])
    x = np.concatenate([c + rng.normal(0, 0.5, (40, 3)) for c in centres])
    df = assemble(spark.createDataFrame(pd.DataFrame(x, columns=list("abc"))), list("abc"))
    weighted = df.selectExpr("features", "1D AS weight").cache()
    sweep = cluster.sweep_clusters(weighted, weighted, ks=(2, 3, 4), restarts=2, silhouette="euclidean")
    assert sweep.best.k == 3 and sweep.kind == "euclidean"
    linear = cluster.sweep_clusters(weighted, weighted, ks=(2, 3), restarts=1)
    assert linear.best.k == 3 and linear.kind == "squared_euclidean"
    with pytest.raises(ValueError, match="distinct points"):
        cluster.sweep_clusters(weighted.limit(3), weighted, ks=(2, 3), restarts=1)
    monkeypatch.setattr(cluster, "LAYOUT_ROWS", 30)  # several partitions
    costs = {n: [round(f.cost, 9) for f in cluster.best_fits(weighted.repartition(n), (2, 3), 2)] for n in (1, 3, 7)}
    assert costs[1] == costs[3] == costs[7]


# The three pillar scores of twenty companies.
PILLAR_SCORES = [
    (95.5, 72.7, 81.0), (99.0, 82.9, 94.8), (85.4, 57.6, 61.6), (53.5, 47.1, 43.0), (68.8, 37.4, 0.0),
    (72.0, 86.3, 65.8), (71.0, 84.0, 83.0), (10.4, 38.7, 55.4), (20.3, 50.7, 55.6), (76.5, 70.3, 89.1),
    (10.7, 30.1, 45.6), (16.7, 40.3, 55.0), (90.4, 76.9, 86.2), (60.1, 74.6, 79.2), (67.0, 62.6, 55.7),
    (27.5, 30.5, 68.8), (89.9, 82.3, 91.5), (26.1, 31.6, 67.6), (71.0, 79.8, 86.0), (84.5, 74.1, 80.8),
]


def test_k_sweep_finds_the_known_figures(spark):
    names = list("abc")
    df = standardise(spark.createDataFrame(pd.DataFrame(PILLAR_SCORES, columns=names)), names, [])
    weighted = assemble(cluster.weigh_points(df, names), names).select("features", "weight").cache()
    sweep = cluster.sweep_clusters(weighted, weighted, silhouette="euclidean")
    assert sweep.silhouettes == {2: 0.593, 3: 0.593, 4: 0.513, 5: 0.398, 6: 0.378}
    assert sweep.best.k == 2 and sorted(sweep.best.model.summary.clusterSizes) == [8, 12]


def test_loadings_have_a_fixed_sign(spark):
    model = fit_components(normalise_01(entities(spark, companies()), CARD, []), CARD)
    for _, rows in loadings_table(model, CARD, spark).toPandas().groupby("component"):
        assert rows.loading[rows.loading.abs().idxmax()] > 0


def test_choice_of_k():
    assert cluster.choose_k({2: 0.59349, 3: 0.59251, 4: 0.61}) == ({2: 0.593, 3: 0.593, 4: 0.61}, 4)
    assert cluster.choose_k({2: 0.59349, 3: 0.59251})[1] == 2


def test_enhancement(spark):
    raw = companies()
    for c in [m.column for m in CARD.of_pillar("env")]:
        raw.loc[0, c] = None
    done = enhance_scorecard(entities(spark, raw), CARD, incomplete="skip", restarts=1)
    got = done.scores.toPandas()
    assert len(got) == len(raw)
    lost = got[got.ticker == "T000"].iloc[0]
    assert pd.isna(lost.cluster_id) and lost.archetype is None
    kept = got[got.ticker != "T000"]
    means = kept.groupby("cluster_id").esg_score_pca.mean()
    assert list(means.index) == list(range(len(means))) and means.is_monotonic_increasing
    np.testing.assert_allclose(
        kept.score_delta, np.rint((kept.esg_score_pca - kept.esg_score_hardcoded) * 10) / 10
    )
    profiles = done.profiles.toPandas().set_index("cluster_id")
    assert profiles.n_companies.sum() == len(kept)
    assert (kept.archetype == kept.cluster_id.map(profiles.archetype)).all()


def test_archetype_rules_in_order(spark):
    rows = [
        (0, 80.0, 80.0, 80.0, 72.0), (1, 19.9, 39.9, 90.0, 50.0), (2, 39.9, 50.0, 65.0, 50.0),
        (3, 60.0, 44.9, 50.0, 60.0), (4, 49.9, 60.0, 50.0, 60.0), (5, 50.0, 50.0, 50.0, 50.0),
    ]
    df = small_table(spark, [(r[0], f"n{r[0]}", *r[1:]) for r in rows], "c int, company string, env_score double, soc_score double, gov_score double, total double")
    got = {r.c: r.archetype for r in cluster_profiles(df, CARD, "c", "total").collect()}
    assert got == {
        0: "Balanced Leaders", 1: "Structural Laggards", 2: "Governance-Strong, E-Weak",
        3: "Environmental Focus", 4: "Social Focus", 5: "Mid-Tier Performers",
    }


def test_member_pages_hold_every_name(spark):
    raw = companies(50)
    df = entities(spark, raw)
    pages = member_pages(df, CARD, "sector", page_rows=4).orderBy("sector", "page").collect()
    for sector, rows in raw.groupby("sector"):
        mine = [p for p in pages if p.sector == sector]
        assert [p.page for p in mine] == list(range(len(mine)))
        assert ", ".join(p.companies for p in mine) == ", ".join(sorted(rows.company))
    whole = {p.sector: p.companies for p in member_pages(df, CARD, "sector").collect()}
    assert whole == {s: ", ".join(sorted(r.company)) for s, r in raw.groupby("sector")}
