import datetime as dt

import pytest

from backframe.plans import analysis, games
from backframe.plans.tables import load
from backframe.session import stored
from tests.conftest import as_dicts


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (float(20 + i % 37), float(i % 11), 3.0, "mf"[i % 2], "abc"[i % 3], i % 5 == 0,
         "yes" if (i * 7) % 10 < 4 else "no", float((i * 13) % 29), dt.date(2024, 1, 1))
        for i in range(200)
    ]
    return spark.createDataFrame(
        rows, "age double, fare double, flat double, sex string, deck string, alone boolean, "
        "alive string, paid double, seen date",
    ).cache()


def test_analysis_of_a_yes_no_response(people):
    out = analysis.analyse(people, "alive")
    assert out.response_kind == "categorical"
    assert out.spec.categorical == ("sex", "deck", "alone")
    assert set(out.tables) == {
        "con/con correlation", "cat/con correlation", "cat/cat correlation",
        "cat/cat difference", "con/con difference", "cat/con difference",
    }
    assert {"contingency sex", "distributions", "densities"} <= set(out.charts)
    report = out.report()
    assert {r["section"] for r in report.collect()} == set(out.tables)
    cells = as_dicts(out.charts["contingency sex"], "x", "y")
    assert cells["m", "True"]["n"] + cells["m", "False"]["n"] == 100


def test_analysis_of_a_continuous_response(people):
    out = analysis.analyse(people, "paid")
    assert out.response_kind == "continuous"
    assert set(as_dicts(out.charts["trends"], "name")) == {"age", "fare", "flat"}
    assert out.charts["distribution deck"].count() > 0


def test_features_of_games(spark, sf_dir):
    table = games.feature_table(lambda n: load(spark, sf_dir, n), stored, days=60)
    assert len(table.columns) == 4 + 60 + 1
    clean = games.feature_table(lambda n: load(spark, sf_dir, n), stored, days=60, clean=True)
    assert "temp" not in clean.columns and clean.count() == table.count()
    wide = games.difference_features(clean)
    assert {"diff_bb", "diff_xbh", "diff_p_ip"} <= set(wide.columns)
    names = ["h_batting_avg", "a_batting_avg", "diff_xbh"]
    judged = analysis.judge_features(clean.select(*names, "hometeam_win"), "hometeam_win", trees=3)
    assert {r["section"] for r in judged.report().collect()} == set(judged.tables)
    assert set(analysis.best_features(judged)) <= set(names)
    assert judged.charts["binned response"].count() == 30


def test_anomalies_and_their_clean_form(spark):
    """The home rate on balls in play is guarded by hits, the away rate by its denominator."""
    sums = {n: 0 for n in ["h", "ab", "hr", "singles", "doubles", "triples", "sf", "bb", "g", "f",
                           "k", "plate", "hbp", "p_o", "p_k", "p_bb", "finalscore", "sub"]}
    row = {f"{s}_{n}": v for s in ("home", "away") for n, v in sums.items()}
    row |= {"home_ab": 5, "away_ab": 5, "home_p_o": 27, "h_team": 1, "a_team": 2,
            "home_streak": 1, "away_streak": -1, "hometeam_win": 1}
    rows = [
        {**row, "game_id": 1, "local_date": dt.date(2024, 5, 1), "temp": "70"},
        {**row, "game_id": 2, "local_date": dt.date(2024, 5, 2), "temp": "unknown"},
        {**row, "game_id": 3, "local_date": dt.date(2024, 5, 3), "temp": "60 "},
    ]
    df = spark.createDataFrame(rows)
    got = as_dicts(games.pair_features(df), "game_id")
    assert set(got) == {2, 3}  # the first game has no history
    assert got[3]["h_babip"] == 0.0 and got[3]["a_babip"] == 1.0
    assert got[3]["avg_temp"] == 35.0 and got[3]["temp"] == "60"
    assert got[3]["h_p_ip"] == 18.0 and got[3]["h_at_bats_per_homerun"] == 0.0
    clean = as_dicts(games.pair_features(df, clean=True), "game_id")
    assert clean[3]["avg_temp"] == 70.0 and clean[3]["a_babip"] == 0.0
