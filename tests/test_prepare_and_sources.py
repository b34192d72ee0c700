import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from backframe import session
from backframe.functions.expressions import ratio, threshold_flag, whole_number
from backframe.operators import prepare, relational
from backframe.plans import games
from backframe.session import shared_folder
from backframe.sources import catalog, datasets, readers
from backframe.sources.report import report, write_report
from tests.conftest import as_dicts


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, 2, 5), (1, 0, 5), (1, 0, 0)], "n int, d int, g int")
    got = df.select(ratio("n", "d").alias("a"), ratio("n", "d", guard="g").alias("b")).collect()
    assert [tuple(r) for r in got] == [(0.5, 0.5), (0.0, None), (0.0, 0.0)]


def test_temperature_text(spark):
    texts = ["72 degrees", "72", "unknown", None, " 80 Degrees"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, temp string")
    stripped = prepare.replace_where_like(df, "temp", "%degrees", "degrees")
    both = stripped.select(whole_number("temp").alias("a"), whole_number("temp", None).alias("b"))
    assert [tuple(r) for r in both.collect()] == [(72, 72), (72, 72), (0, None), (None, None), (0, None)]


def test_events_match_in_any_case(spark):
    df = spark.createDataFrame(
        [(1, 0, "Pitching Substitution"), (1, 0, "PITCHING SUBSTITUTION"), (1, 1, "Single")],
        "game_id int, half int, event string",
    )
    assert [tuple(r) for r in games.substitutions(df).collect()] == [(1, 2, None)]


@pytest.fixture()
def mixed(spark):
    rows = [(1.0, 1, 1.0, "a", True, 1, "yes", dt.date(2024, 1, 1)),
            (2.0, 2, 7.0, "b", False, 0, "no", dt.date(2024, 1, 2)),
            (float("nan"), 3, 7.0, None, True, None, "No", None)]
    return spark.createDataFrame(
        rows, "x double, n int, c double, s string, f boolean, y int, w string, d date"
    )


def test_columns_by_type(mixed):
    spec = prepare.classify_columns(mixed, "y")
    assert spec.continuous == ("x", "n", "c")
    assert spec.categorical == ("s", "f", "w")


def test_response_kinds(spark):
    def kind(values, schema="y int"):
        df = spark.createDataFrame([(v,) for v in values], schema)
        return prepare.response_kind(df, "y").first()["kind"]

    assert kind([0, 1, 1]) == "categorical"
    assert kind([3, 5, 3]) == "categorical"
    assert kind([0, 1, None]) == "continuous"  # a missing value is a third value
    assert kind([1, 1, None]) == "categorical"
    assert kind([1, 1]) == "continuous"
    assert kind([1, 2, 3]) == "continuous"
    assert kind(["yes", "no"], "y string") == "categorical"


def test_truth_words(mixed, spark):
    got = prepare.binary_response(mixed, "w", alias="z")
    assert [r["z"] for r in got.collect()] == [1, 0, 0]
    assert [r["y"] for r in prepare.binary_response(mixed, "y").collect()] == [1, 0, None]
    odd = spark.createDataFrame([("maybe",)], "w string")
    with pytest.raises(PySparkException):
        prepare.binary_response(odd, "w").collect()


def test_nulls(mixed):
    assert prepare.drop_null_rows(mixed, ["x", "n"]).count() == 2
    assert [r["y"] for r in prepare.fill_zero(mixed, ["y"]).collect()] == [1, 0, 0]
    assert [r["x"] for r in prepare.impute_mean(mixed, ["x", "y"]).collect()] == [1.0, 2.0, 1.5]
    assert [r["y"] for r in prepare.impute_mean(mixed, ["x", "y"]).collect()] == [1.0, 0.0, 0.5]


def test_flags(spark):
    df = spark.createDataFrame([(0.5,), (-1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(threshold_flag("v")).collect()] == ["1", "0", "0"]


def test_duplicate_columns_keep_the_last(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1, "1", 5.0), (None, None, 2, None, 6.0), (3, 3.0, 3, "3", 5.0)],
        "a int, b double, c int, d string, e double",
    )
    assert prepare.duplicate_columns(df) == ["a"]
    assert prepare.drop_duplicate_columns(df).columns == ["b", "c", "d", "e"]
    again = df.withColumn("z", F.col("a"))
    assert prepare.duplicate_columns(again) == ["a", "b"]


def test_pairing_needs_two_teams(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1, 10, day, "H", "W"), (1, 11, day, "A", "L"), (2, 10, day, "H", "L"),
            (3, 10, day, "H", "W"), (3, 11, day, "A", "L"), (3, 12, day, "A", "L")]
    df = spark.createDataFrame(
        rows, "game_id int, team_id int, local_date date, home_away string, win_lose string"
    )
    got = sorted((r["game_id"], r["h_team"], r["a_team"], r["hometeam_win"])
                 for r in games.opponents(df).collect())
    assert got == [(1, 10, 11, 1), (3, 10, 11, 1), (3, 10, 12, 1)]
    pairs = df.where("game_id = 1")
    assert games.opponents(pairs, exactly_two=True).collect() == games.opponents(pairs).collect()


def test_contingency_covers_both_label_sets(spark):
    df = spark.createDataFrame([("a", "True"), ("a", "False"), ("b", "True")], "x string, y string")
    got = as_dicts(relational.contingency(df, "x", "y"), "x", "y")
    assert len(got) == 16
    assert got["a", "True"]["n"] == 1 and got["True", "a"]["n"] == 0
    many = spark.range(1100).selectExpr("CAST(id AS STRING) AS x", "CAST(id AS STRING) AS y")
    assert relational.contingency(many, "x", "y").count() == 1100 * 1100
    assert relational.observed_cells(df, "x", "y").count() == 3


def test_unique_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert [tuple(r) for r in relational.duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_positional_text(spark, tmp_path):
    path = tmp_path / "flowers.data"
    path.write_text("5.1,3.5,setosa\n4.9,3.0,setosa\n6.3,3.3,virginica\n\n")
    df = readers.read_positional_csv(spark, str(path), "length double, width double, kind string")
    assert df.columns == ["length", "width", "kind"]
    assert df.count() == 3


def test_database_reader_options():
    options = readers.jdbc_options(
        "jdbc:mysql://db:3306/league", "league.games", "u", "p", "org.mariadb.jdbc.Driver",
        readers.JdbcSplit("game_id", 0, 9000, 16),
    )
    assert options["dbtable"] == "league.games"
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "game_id"
    assert "numPartitions" not in readers.jdbc_options("u", "t", "a", "b", "d")


def test_required_columns(mixed):
    assert readers.require_columns(mixed, ["x"]) is mixed
    with pytest.raises(ValueError):
        readers.require_columns(mixed, ["x", "absent"])


def test_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    for _ in range(2):
        stored = catalog.create_table_as(df, "kept_table", str(tmp_path / "kept"))
    assert stored.count() == 1
    assert "kept_table" in catalog.table_names(spark)
    catalog.drop_table(spark, "kept_table")
    assert "kept_table" not in catalog.table_names(spark)
    assert "default" in catalog.database_names(spark)


def test_named_data_sets(spark):
    cars = spark.createDataFrame(
        [(18.0, 8, "a", "usa"), (20.0, None, "b", "japan")],
        "mpg double, cylinders int, name string, origin string",
    )
    data, predictors, response = datasets.load_dataset("mpg", lambda: cars)
    assert response == "mpg" and "weight" in predictors and "name" not in data.columns
    assert data.count() == 1
    sick = spark.createDataFrame([(0.5, 1.0), (-0.5, 2.0)], "sex double, target double")
    data, predictors, _ = datasets.load_dataset("diabetes", lambda: sick)
    assert [r["gender"] for r in data.collect()] == ["1", "0"] and predictors == ["sex"]
    with pytest.raises(ValueError):
        datasets.load_dataset("no such set", lambda: cars)


def test_report_files(spark, tmp_path):
    scores = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "name string, score double")
    out = report({"scores": (scores, ["name"], "score")})
    assert [(r["rank"], r["item"]) for r in out.orderBy("rank").collect()] == [(1, "b"), (2, "a")]
    write_report(out, str(tmp_path / "report"))
    files = list((tmp_path / "report" / "section=scores").glob("*.json"))
    lines = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert {r["item"]: r["rank"] for r in lines} == {"b": 1, "a": 2}


def test_stored_frames_are_files_in_the_shared_folder(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == shared_folder(spark)
    assert named in (None, shared_folder(spark))
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    kept = session.stored(df, "kept")
    assert kept.collect() == df.collect()
    assert all(str(tmp_path) in f for f in kept.inputFiles())
