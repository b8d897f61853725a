import json

import pytest
from fixture import CARD, companies, entities

from scoreloom import read_entities, run_enhancement, run_scorecard
from scoreloom.functions.literals import small_table
from scoreloom.plans import staging
from scoreloom.sources.readers import clean_name, nulls_for_nan, read_csv
from scoreloom.sources.writers import write_table


def test_header_is_cleaned():
    assert [clean_name(c) for c in (" ticker ", "a  b", "x")] == ["ticker", "a_b", "x"]


def test_csv_nulls_and_types(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(" ticker ,a  b,n,extra\nX,1.5,3,p\nNA,2,4,q\nY,NaN,,null\n,1,1,r\n")
    df = read_csv(spark, str(path), "ticker string, n int, a_b double")
    assert df.columns == ["ticker", "a_b", "n", "extra"]
    rows = {r.ticker: r for r in df.na.drop(subset=["ticker"]).collect()}
    assert set(rows) == {"X", "Y"}
    assert rows["X"].a_b == 1.5 and rows["X"].n == 3
    assert rows["Y"].a_b is None and rows["Y"].n is None and rows["Y"].extra is None


def test_csv_rejects_what_does_not_fit(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("ticker,n\nX,many\n")
    with pytest.raises(Exception, match="n: not a int: many"):
        read_csv(spark, str(path), "ticker string, n int").collect()
    with pytest.raises(ValueError, match="lacks"):
        read_csv(spark, str(path), "ticker string, m int")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, s string")
    assert [r.x for r in nulls_for_nan(df).orderBy("s").collect()] == [None, 1.0]


def test_round_trip_of_the_scorecard(spark, tmp_path):
    raw = companies(24)
    raw.to_csv(tmp_path / "in.csv", index=False)
    df = read_entities(spark, str(tmp_path / "in.csv"), CARD)
    out = str(tmp_path / "out")
    master = run_scorecard(df, CARD, out, scoring_date="2024-02-03")
    assert master.count() == 24
    for name, rows in (("esg_scores_master", 24), ("esg_scores_long", 72), ("esg_metric_detail", 288), ("esg_sector_summary", 4)):
        written = spark.read.csv(f"{out}/{name}", header=True)
        assert written.count() == rows
    files = sorted((tmp_path / "out" / "esg_sector_summary").glob("part-*"))
    sectors = [line.split(",")[0] for f in files for line in f.read_text().splitlines()[1:]]
    assert sectors == sorted(sectors)
    record = json.loads(spark.read.text(f"{out}/scoring_framework").first()[0])
    assert record["companies_scored"] == 24 and record["scoring_date"] == "2024-02-03"
    assert record["pillars"]["Social"]["weight"] == "35%"
    assert list(record["rating_bands"]) == ["A+", "A", "B+", "B", "C+", "C", "D"]
    assert record["rating_bands"]["A+"] == "85–100"


def test_round_trip_of_the_enhancement(spark, tmp_path):
    out = str(tmp_path / "out")
    done = run_enhancement(entities(spark, companies(24)), CARD, out, fmt="parquet", fiscal_year=2023, restarts=1)
    assert spark.read.parquet(f"{out}/esg_ml_scores").count() == 24
    assert spark.read.parquet(f"{out}/pca_explained_variance").columns == [
        "component", "explained_variance_pct", "dominant_pillar",
    ]
    record = json.loads(spark.read.text(f"{out}/ml_methodology").first()[0])
    assert record["companies"] == 24 and record["metrics"] == 15 and record["fiscal_year"] == 2023
    assert record["clustering"]["optimal_k"] == done.sweep.best.k
    assert set(record["clustering"]["silhouette_scores"]) == {"2", "3", "4", "5", "6"}
    assert sum(a["n_companies"] for a in record["clustering"]["archetypes"]) == 24
    assert record["pca"]["vs_hardcoded"] == {"Environmental": "40.0%", "Social": "35.0%", "Governance": "25.0%"}


def test_partitioned_sink(spark, tmp_path):
    write_table(spark.range(4).selectExpr("id", "id % 2 AS p"), str(tmp_path / "t"), "parquet", partition_by="p")
    assert {d.name for d in (tmp_path / "t").glob("p=*")} == {"p=0", "p=1"}


def test_staging_folder(spark, tmp_path):
    class Conf:
        def __init__(self, value):
            self.get = lambda key, default: value if key == "spark.checkpoint.dir" else default

    class Session:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("C", (), {"master": master, "applicationId": "test"})()

    assert staging.staging_root(Session("hdfs://shared/dir/", "yarn")) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_root(Session(None, "yarn"))
    assert staging.staging_root(Session(None, "local[2]")) == staging.staging_root(Session(None, "local[2]"))


def test_csv_keeps_quotes_commas_and_blanks(spark, tmp_path):
    rows = [(1, 'Foo "Bar", Inc'), (2, "  both ends  "), (3, None), (4, "a,b")]
    write_table(small_table(spark, rows, "n int, t string"), str(tmp_path / "t"))
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("*.csv"))
    assert '"Foo ""Bar"", Inc"' in text
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "t"), "n int, t string").collect())) == rows


def test_csv_refuses_files_of_other_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("ticker,a,b\nA,1,100\n")
    (tmp_path / "2.csv").write_text("ticker,b,a\nB,200,2\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path), "ticker string, a int, b int").collect()


def test_csv_cells_fit_without_ansi(spark, tmp_path):
    (tmp_path / "1.csv").write_text("n\nmany\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a int"):
            read_csv(spark, str(tmp_path), "n int").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
