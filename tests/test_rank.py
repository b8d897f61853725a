import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from scoreloom.operators import quantiles as module
from scoreloom.operators.quantiles import describe, exact_quantiles
from scoreloom.operators.rank import (
    bottom_n,
    group_percentiles,
    top_n,
    with_group_position,
    with_position,
)


def table(spark, n=3000, seed=3):
    """A third of all rows in one group, and a third of all rows with one score."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "key": np.arange(n),
            "grp": np.where(rng.random(n) < 0.34, "hot", "g" + pd.Series(rng.integers(0, 9, n)).astype(str)),
            "s": np.where(rng.random(n) < 0.34, 41.5, rng.integers(0, 1001, n) / 10.0),
        }
    )
    pdf.loc[::50, "s"] = np.nan
    pdf.loc[::70, "grp"] = None
    rows = [(int(k), g, None if np.isnan(s) else float(s)) for k, g, s in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "key long, grp string, s double")


def test_percentiles_match_pandas_and_the_window_form(spark):
    pdf, df = table(spark)
    got = group_percentiles(df, "grp", ["s"]).orderBy("key").toPandas()["s_grp_pct"]
    want = np.rint(pdf.groupby("grp")["s"].rank(pct=True) * 100 * 10) / 10
    np.testing.assert_array_equal(got, want)

    group, ties = Window.partitionBy("grp"), Window.partitionBy("grp", "s")
    mean_rank = F.rank().over(group.orderBy(F.col("s").asc_nulls_last())) + (F.count("s").over(ties) - 1) / 2
    pct = F.rint(mean_rank / F.count("s").over(group) * 100 * 10) / 10
    plain = df.withColumn("p", F.when(F.col("s").isNotNull() & F.col("grp").isNotNull(), pct))
    np.testing.assert_array_equal(got, plain.orderBy("key").toPandas()["p"])


def test_average_rank_of_ties(spark):
    df = spark.createDataFrame([(i, "g", s) for i, s in enumerate([1.0, 2.0, 2.0, None, 5.0])], "key int, grp string, s double")
    got = group_percentiles(df, "grp", ["s"]).orderBy("key").toPandas()["s_grp_pct"]
    np.testing.assert_array_equal(got, [25.0, 62.5, 62.5, np.nan, 100.0])


def test_positions(spark):
    pdf, df = table(spark)
    got = with_position(df, [F.desc_nulls_last("s"), F.asc("key")]).toPandas()
    want = pdf.sort_values(["s", "key"], ascending=[False, True], na_position="last").key.tolist()
    assert got.sort_values("position").key.tolist() == want
    assert got.position.tolist() != [] and sorted(got.position) == list(range(1, len(pdf) + 1))

    grouped = with_group_position(df, "grp", [F.asc("s"), F.asc("key")]).toPandas()
    for _, rows in grouped.groupby("grp", dropna=False):
        assert sorted(rows.position) == list(range(1, len(rows) + 1))
        ordered = rows.sort_values("position")
        assert ordered.key.tolist() == rows.sort_values(["s", "key"], na_position="first").key.tolist()


def test_top_and_bottom_put_nulls_last(spark):
    df = spark.createDataFrame([(3, 1.0), (1, None), (2, 1.0), (4, 9.0)], "key int, s double")
    assert [r.key for r in top_n(df, "s", "key", 3).collect()] == [4, 2, 3]
    assert [r.key for r in bottom_n(df, "s", "key", 3).collect()] == [2, 3, 4]
    assert [r.key for r in top_n(df, "s", "key", 9).collect()] == [4, 2, 3, 1]


def quantiles(df, columns, probs, **options):
    return {(r.metric, r.prob): r.value for r in exact_quantiles(df, columns, probs, **options).collect()}


def test_quantiles_with_and_without_brackets(spark):
    rng = np.random.default_rng(5)
    n = 20_000
    pdf = pd.DataFrame(
        {
            "even": rng.random(n),
            "skewed": np.exp(rng.normal(0, 4, n)),
            "tied": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 20, n)).astype(float),
            "constant": 1.0,
        }
    )
    pdf.loc[::11, "even"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "even double, skewed double, tied double, constant double")
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    for keep in (0, 50, 10**9):
        got = quantiles(df, list(pdf), probs, keep=keep)
        for c in pdf:
            for p in probs:
                np.testing.assert_allclose(got[c, p], pdf[c].quantile(p), rtol=1e-12)


def test_cuts_in_the_wrong_place_cost_rounds_only(spark, monkeypatch):
    monkeypatch.setattr(module, "MARGIN", -0.1)  # cuts pass the wanted place on both sides
    monkeypatch.setattr(module, "ACCURACY", 100)
    pdf = pd.DataFrame({"a": np.random.default_rng(6).normal(size=3_000)})
    got = quantiles(spark.createDataFrame(pdf), ["a"], (0.1, 0.5, 0.99), keep=20)
    for p in (0.1, 0.5, 0.99):
        np.testing.assert_allclose(got["a", p], pdf.a.quantile(p), rtol=1e-12)


def test_quantiles_of_few_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert quantiles(df, ["a", "b"], (0.25, 0.5), keep=0) == {("a", 0.25): 1.25, ("a", 0.5): 1.5}


def test_describe(spark):
    pdf = pd.DataFrame({"a": [0.0, 0.5, 1.0, 0.25], "b": [1.0, 1.0, 1.0, 1.0]})
    got = describe(spark.createDataFrame(pdf), ["a", "b"]).toPandas().set_index("metric")
    want = pdf.describe().round(3).T
    names = {"count": "n", "25%": "q25", "50%": "q50", "75%": "q75"}
    np.testing.assert_array_equal(got.loc[["a", "b"], list(want.rename(columns=names))], want)
