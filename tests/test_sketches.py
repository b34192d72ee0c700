"""Sketches: measured error, merging, groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from backframe.operators import sketches
from tests.conftest import as_dicts

SHARES = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(12)
    n = 60_000
    return pd.DataFrame(
        {
            "even": rng.uniform(size=n),
            "skewed": np.exp(rng.normal(0, 5, n)),
            "ties": rng.integers(0, 9, n).astype(float),
            "day": rng.integers(0, 30, n),
            "kind": rng.choice(["a", "b", "c"], n, p=[0.9, 0.09, 0.01]),
        }
    )


@pytest.mark.parametrize("size", [50, 200, 800])
def test_error_is_the_one_stated_whole_and_merged(spark, frame, size):
    df = spark.createDataFrame(frame).repartition(16)
    columns = ["even", "skewed", "ties"]
    once = sketches.quantile_sketches(df, columns, size=size)
    daily = sketches.quantile_sketches(df, columns, ["kind", "day"], size)
    for made in (once, sketches.merged_sketches(daily)):
        for r in sketches.sketched_quantiles(made, SHARES).collect():
            v = np.sort(frame[r["name"]].to_numpy())
            low, high = np.searchsorted(v, r["value"], "left") / len(v), np.searchsorted(v, r["value"], "right") / len(v)
            off = max(low - r["p"], r["p"] - high, 0)
            assert off <= 1.5 * sketches.rank_error(size)
            assert r["n"] == len(v)


def test_groups_merge_to_their_own(spark, frame):
    df = spark.createDataFrame(frame)
    daily = sketches.quantile_sketches(df, ["skewed"], ["kind", "day"])
    got = as_dicts(sketches.sketched_ranks(sketches.merged_sketches(daily, ["kind"]), [1.0]), "kind")
    for kind, own in frame.groupby("kind"):
        assert got[kind]["n"] == len(own)
        assert got[kind]["share"] == pytest.approx((own["skewed"] <= 1.0).mean(), abs=0.03)


def test_missing_values_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None)], "a double, b double")
    rows = sketches.quantile_sketches(df, ["a", "b"]).collect()
    assert [(r["name"], r["n"]) for r in rows] == [("a", 1)]
    assert sketches.quantile_sketches(df.limit(0), ["a"]).count() == 0
    assert sketches.merged_sketches(sketches.quantile_sketches(df, ["a"]).where(F.lit(False))).count() == 0
