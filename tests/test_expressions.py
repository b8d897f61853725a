import pytest

from scoreloom.functions import expressions as E
from scoreloom.functions.literals import small_table


def apply(spark, expression, values, kind="double"):
    df = small_table(spark, list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").selectExpr(expression).collect()]


def test_rounding_is_half_even(spark):
    got = apply(spark, E.round_half_even("x"), [0.25, 2.35, 1.15, -0.25, None, 100.0])
    assert got == [0.2, 2.4, 1.2, -0.2, None, 100.0]


def test_clip_keeps_nulls(spark):
    assert apply(spark, E.clip("x", 0, 100), [-3.0, 0.0, 55.5, 101.0, None]) == [0.0, 0.0, 55.5, 100.0, None]


def test_penalty_grows_to_its_cap(spark):
    got = apply(spark, E.penalty("x", 4), [-1, 0, 2, 4, 9, None], "int")
    assert got == [0.0, 0.0, 5.0, 10.0, 10.0, None]


def test_rating_bins_are_right_closed(spark):
    scores = [0.0, 0.1, 30.0, 30.1, 45.0, 55.0, 65.0, 75.0, 85.0, 100.0, 100.1, None]
    want = [None, "D", "D", "C", "C", "C+", "B", "B+", "A", "A+", None, None]
    assert apply(spark, E.rating("x"), scores) == want


def test_bands_include_their_lower_bound(spark):
    got = apply(spark, E.band("x"), [75.0, 74.9, 55.0, 54.9, 35.0, 34.9, None])
    assert got == ["Leader", "Average", "Average", "Laggard", "Laggard", "Critical", "Critical"]


def test_row_mean_skips_nulls(spark):
    df = small_table(spark, [(1.0, 2.0), (None, 4.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.selectExpr(E.row_mean(["a", "b"])).collect()] == [1.5, 4.0, None]


def test_mean_of_rounded_does_not_depend_on_partitions(spark):
    scores = [(round(i * 0.1, 1),) for i in range(1001)]
    df = spark.createDataFrame(scores, "s double")
    means = {df.repartition(n).selectExpr(E.mean_of_rounded("s")).first()[0] for n in (1, 3, 7)}
    assert means == {50.0}


def test_texts(spark):
    df = small_table(spark, [(75.9, "A"), (None, None), (100.0, "A+")], "s double, r string")
    assert [r[0] for r in df.selectExpr(E.score_text("s", "r")).collect()] == ["75.9 (A)", "nan (nan)", "100.0 (A+)"]
    assert apply(spark, E.percent_text("x"), [0.0025, 0.647]) == ["0.2%", "64.7%"]
    assert apply(spark, E.lookup("x", {"it's": "a\\b"}), ["it's", "other", None], "string") == ["a\\b", None, None]


@pytest.mark.parametrize("value", [0.25, -3.0, 1e-7, float("inf"), None])
def test_literals(spark, value):
    assert spark.range(1).selectExpr(E.num(value)).first()[0] == value
