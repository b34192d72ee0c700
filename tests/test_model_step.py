"""The step before the model fits: games, their features, and the preparation of wide rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from backframe.operators import trailing
from backframe.operators.preparation import Preparation
from backframe.plans import games
from backframe.plans.table_queries import assembled_games
from backframe.session import settings


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_derived_columns_are_of_the_totals(spark):
    day = [dt.date(2024, 1, d) for d in (1, 2, 2, 3, 20)]
    rows = [(i, "a", d, v) for i, (d, v) in enumerate(zip(day, [1, 2, None, 4, 5]))] + [(9, None, day[0], 7)]
    df = spark.createDataFrame(rows, "id int, k string, day date, v int")
    args = (df, ["k"], "day", {"s": "v", "m": F.lit(1)}, 5)
    plain = trailing.with_trailing_totals(*args, carry=["id"]).select("id", "n_matches", (F.col("s") / F.col("m")).alias("mean"))
    derived = trailing.with_trailing_totals(*args, carry=["id"], derive={"mean": F.col("s") / F.col("m")})
    assert derived.columns == ["id", "n_matches", "mean"]
    assert sorted(derived.collect()) == sorted(plain.collect())
    assert {r["id"]: r["mean"] for r in derived.collect()} == {1: 1.0, 2: 1.0, 3: 1.0}


def test_features_are_worked_out_before_the_games_join(spark, sf_dir):
    """Games that share pair and day share the work: rates stand below the join."""
    plan = _plan(games.pair_features(assembled_games(spark, sf_dir), clean=True))
    assert "AS h_babip" in plan.partition("Join Inner")[2]
    assert "AS h_babip" not in plan.partition("Join Inner")[0]


def test_games_meet_where_they_lie(spark, sf_dir):
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        apart = assembled_games(spark, sf_dir)
        before = _exchanges(apart)
        with settings(spark, games.CO_LOCATED):
            together = assembled_games(spark, sf_dir)
            assert _exchanges(together) < before
            got = sorted(map(str, together.collect()))
        assert got == sorted(map(str, apart.collect()))
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == own


def test_settings_return_after_a_failure(spark):
    with pytest.raises(ValueError), settings(spark, {"backframe.none": "1", **games.CO_LOCATED}):
        assert spark.conf.get("backframe.none") == "1"
        raise ValueError
    assert spark.conf.get("backframe.none", None) is None
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_means_and_deviations_of_many_columns(spark):
    """NaN and null count as missing, in each of them."""
    names = [f"c{i}" for i in range(80)]
    rows = [tuple(float("nan") if i == j else None if i == j + 1 else float(i * j) for i in range(79)) + (None,) for j in range(5)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    seen = []
    model = Preparation(names, scaled=True).fit(df)
    means, deviations = model.getOrDefault(model.means), model.getOrDefault(model.deviations)
    for i, n in enumerate(names):
        known = [r[i] for r in rows if r[i] is not None and not math.isnan(r[i])]
        mean = sum(known) / len(known) if known else 0.0
        spread = math.sqrt(sum((v - mean) ** 2 for v in known) / len(known)) if known else 0.0
        seen.append((math.isclose(means[i], mean, abs_tol=1e-9), math.isclose(deviations[i], spread or 1.0, rel_tol=1e-9)))
    assert all(a and b for a, b in seen)
    assert model.transform(df).where("c79 <> 0 OR c0 IS NULL").count() == 0
