import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from backframe.operators import association, bins, distribution, pairs, ranks
from tests.conftest import as_dicts


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(11)
    n = 900
    df = pd.DataFrame(
        {
            "a": rng.normal(size=n).round(2),
            "b": rng.integers(0, 40, n).astype(float),
            "c": rng.exponential(size=n),
            "flat": 4.0,
            "kind": rng.choice(["x", "y", "z"], n, p=[0.6, 0.3, 0.1]),
            "size": rng.choice(["s", "m"], n),
            "y": rng.integers(0, 2, n),
        }
    )
    df["b2"] = df["a"] * 2 + rng.normal(size=n) * 0.2
    df.loc[::17, "b"] = np.nan
    df.loc[::23, "kind"] = None
    return df


@pytest.fixture(scope="module")
def df(spark, frame):
    clean = frame.astype(object).where(frame.notna(), None)
    schema = ("a double, b double, c double, flat double, kind string, size string, y int, "
              "b2 double")
    return spark.createDataFrame(clean.values.tolist(), schema).cache()


CON = ["a", "b", "c", "flat", "b2"]


def cut(values, n=10):
    return pd.cut(values, bins=n, labels=False)


@pytest.mark.parametrize("n", [2, 10])
def test_bins_like_pandas(df, frame, n):
    got = bins.with_bins(df, CON, n).toPandas()
    for c in CON:
        assert got[f"{c}_bin"].fillna(-1).astype(int).tolist() == (
            cut(frame[c], n).fillna(-1).astype(int).tolist()
        )


def test_fine_bins_equal_edge_comparison(spark):
    values = [float(v) for v in np.linspace(-1, 1, 401)] + [0.1, 0.3, 0.7]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = bins.overview(df, ["v"], 10).ranges[0]
    both = bins.with_fine_bin(
        df.withColumn("e", bins.bin_by_edges(F.col("v"), r)), "v", F.lit(r.lo), F.lit(r.step), 10, "f"
    )
    assert both.where("e <> f").count() == 0


def test_value_on_an_edge_goes_left(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    got = {r["v"]: r["v_bin"] for r in bins.with_bins(df, ["v"]).collect()}
    assert got == {0.0: 0, 1.0: 0, **{float(v): v - 1 for v in range(2, 11)}}


def test_edges_like_pandas(spark, df, frame):
    facts = bins.overview(df, CON, 10)
    got = as_dicts(bins.bin_edges(df, CON, facts.ranges), "name", "bin")
    for c in CON:
        intervals = pd.cut(frame[c], bins=10, precision=12).cat.categories
        for k, i in enumerate(intervals):
            assert got[c, k]["lower"] == pytest.approx(i.left, abs=1e-9)
            assert got[c, k]["middle"] == pytest.approx(i.mid, abs=1e-9)


def test_pearson_like_pandas(df, frame):
    got = as_dicts(association.pearson(df, CON), "x1", "x2")
    want = frame[CON].corr().stack()
    assert set(got) == set(want.index)  # the constant column has no correlation
    for key, value in want.items():
        assert got[key]["value"] == pytest.approx(value, abs=1e-9)


def test_correlation_ratio(df, frame):
    got = as_dicts(association.correlation_ratio(df, ["kind", "size"], ["a", "c", "flat"]), "x1", "x2")
    for cat, con in itertools.product(["kind", "size"], ["a", "c", "flat"]):
        known = frame[frame[cat].notna()]
        groups = known.groupby(cat)[con].agg(["count", "mean"])
        mean = (groups["count"] * groups["mean"]).sum() / groups["count"].sum()
        between = (groups["count"] * (groups["mean"] - mean) ** 2).sum()
        want = 0.0 if con == "flat" else math.sqrt(between / ((frame[con] - mean) ** 2).sum())
        assert got[cat, con]["value"] == pytest.approx(want, abs=1e-7)


def test_cramers_v_bounds_and_symmetry(df):
    for corrected in (True, False):
        got = as_dicts(association.cramers_v(df, ["kind", "size"], corrected), "x1", "x2")
        assert got["kind", "size"]["value"] == got["size", "kind"]["value"]
        assert got["kind", "kind"]["value"] == pytest.approx(1.0)
        assert all(0 <= r["value"] <= 1 for r in got.values())


def within(frame, key1, key2):
    mean, n = frame["y"].mean(), len(frame)
    rows = [
        (((g["y"] - mean) ** 2).mean(), len(g) / n)
        for _, g in frame.assign(k1=key1, k2=key2).dropna(subset=["k1", "k2"]).groupby(["k1", "k2"])
    ]
    d = np.array(rows)
    return d[:, 0].mean(), (d[:, 0] * d[:, 1]).mean()


def between(frame, key1, key2):
    mean = frame["y"].mean()
    groups = frame.assign(k1=key1, k2=key2).dropna(subset=["k1", "k2"]).groupby(["k1", "k2"])["y"]
    g = groups.agg(["mean", "count"])
    d = (g["mean"] - mean) ** 2
    return d.sum() / len(d), (d * g["count"] / g["count"].sum()).sum()


def test_brute_force_numbers(df, frame):
    for score, reference in (("within", within), ("between", between)):
        got = as_dicts(pairs.brute_force(df, "y", continuous=CON, score=score), "x1", "x2")
        assert len(got) == 10
        for a, b in itertools.combinations(CON, 2):
            want = reference(frame, cut(frame[a]), cut(frame[b]))
            assert (got[a, b]["mse"], got[a, b]["wmse"]) == pytest.approx(want, abs=1e-9)


def test_brute_force_categories(df, frame):
    got = as_dicts(pairs.brute_force(df, "y", categorical=["kind", "size"]), "x1", "x2")
    want = within(frame, frame["kind"], frame["size"])
    assert (got["kind", "size"]["mse"], got["kind", "size"]["wmse"]) == pytest.approx(want, abs=1e-9)
    got = as_dicts(
        pairs.brute_force(df, "y", continuous=["a", "b"], categorical=["kind"]), "x1", "x2"
    )
    for c in ("a", "b"):
        want = within(frame, frame["kind"], cut(frame[c]))
        assert (got["kind", c]["mse"], got["kind", c]["wmse"]) == pytest.approx(want, abs=1e-9)


def test_cells_add_up(df, frame):
    got = pairs.cells(df, "y", continuous=["a", "c"]).agg({"n": "sum"}).first()[0]
    assert got == len(frame)


def test_empty_bins_count_in_the_divisor(df, frame):
    got = as_dicts(pairs.mean_of_response(df, "y", ["c", "flat"]), "name")
    for c in ("c", "flat"):
        g = frame.assign(k=cut(frame[c])).groupby("k")["y"].agg(["mean", "count"])
        d = (g["mean"] - frame["y"].mean()) ** 2
        assert got[c]["mse"] == pytest.approx(d.sum() / 10, abs=1e-12)
        assert got[c]["wmse"] == pytest.approx((d * g["count"] / g["count"].sum()).sum(), abs=1e-12)
    table = pairs.binned_response(df, "y", ["flat"])
    assert table.count() == 10 and table.where("n > 0").first()["bin"] == 4


@pytest.mark.parametrize(("fan", "few"), [(2, 1), (3, 40), (1024, 4096)])
def test_quantiles_are_exact(df, frame, fan, few):
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = as_dicts(
        distribution.quantiles(df, ["a", "b", "c", "flat"], ps, "size", fan, few),
        "name", "class", "p",
    )
    for c, s, p in itertools.product(["a", "b", "c", "flat"], ["s", "m"], ps):
        values = frame.loc[frame["size"] == s, c].dropna()
        assert got[c, s, p]["value"] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_quantiles_beside_values_far_out(spark):
    values = [float(v) for v in range(5000)] + [1e12, -1e300, 1.7e308, -1.7e308, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = as_dicts(distribution.quantiles(df, ["v"], [0.0, 0.3, 0.5, 1.0]), "p")
    for p in (0.0, 0.3, 0.5, 1.0):
        assert got[p]["value"] == np.quantile(values, p)


def test_no_bucket_keeps_many_values_beside_one_far_out(spark, monkeypatch):
    """What is left to be counted one by one is bounded, whatever lies far out."""
    df = spark.range(200_000).select(F.when(F.col("id") == 7, 1e12).otherwise(F.col("id") % 50_000).alias("v"))
    rows = df.select(F.lit(0).alias("i"), "v", F.lit(1).alias("n"))
    wanted = spark.createDataFrame([(0, 100_000)], "i int, k long")
    seen = []
    real = ranks.stored
    monkeypatch.setattr(ranks, "stored", lambda f, name: seen.append(real(f, name)) or seen[-1])
    assert ranks.values_at_ranks(rows, ["i"], wanted).first()["v"] == sorted(i % 50_000 for i in range(200_000))[100_000]
    assert [f.first()["m"] for f in seen][1] >= 199_000  # the value far out has the first round's buckets to itself
    assert all(f.first()["m"] <= 4096 for f in seen[2:])


def test_histogram_holds_every_row(df, frame):
    few = distribution.class_histogram(df, ["a", "b"], "kind", 0.2)
    n = few.groupBy("name").agg(F.sum("n").alias("n"))
    for c, total in as_dicts(n, "name").items():
        assert total["n"] == frame.dropna(subset=[c, "kind"]).shape[0]
    area = few.groupBy("name", "class").agg(F.sum(F.col("density") * 0.2).alias("a"))
    assert all(r["a"] == pytest.approx(1.0) for r in area.collect())


def test_density_curve(df, frame):
    got = distribution.class_kde(df, ["a", "b", "flat"], "size", points=25).toPandas()
    assert set(got["name"]) == {"a", "b"}
    for (c, s), part in got.groupby(["name", "class"]):
        v = frame.loc[frame["size"] == s, c].dropna().to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        part = part.sort_values("point")
        x = np.linspace(v.min(), v.max(), 25)
        want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * math.sqrt(2 * math.pi))
        assert part["x"].to_numpy() == pytest.approx(x)
        assert part["density"].to_numpy() == pytest.approx(want, rel=1e-3)


@pytest.mark.parametrize("place", [0.0, 1e9])
def test_density_curve_far_from_zero_and_with_an_outlier(spark, place):
    random = np.random.default_rng(4)
    values = np.concatenate([random.uniform(0, 2, 3000), [90.0]]) + place
    df = spark.createDataFrame(pd.DataFrame({"v": values, "k": "x"}))
    got = distribution.class_kde(df, ["v"], "k", points=40).toPandas().sort_values("point")
    h = values.std(ddof=1) * len(values) ** -0.2
    x = np.linspace(values.min(), values.max(), 40)
    want = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert got["density"].to_numpy() == pytest.approx(want, rel=1e-3, abs=1e-6)


def test_missing_responses_take_no_part(spark):
    rows = [("a", "p", 1.0), ("a", "p", None), ("a", "q", 0.0), ("b", "q", 0.0), ("b", "q", float("nan"))]
    df = spark.createDataFrame(rows, "x string, z string, y double")
    got = {(r.cell1, r.cell2): r for r in pairs.cells(df, "y", categorical=["x", "z"]).collect()}
    assert {k: r.n for k, r in got.items()} == {("a", "p"): 1, ("a", "q"): 1, ("b", "q"): 1}
    assert got["a", "p"]["mean"] == pytest.approx(1.0)
    assert got["a", "p"]["within"] == pytest.approx(4 / 9)
    assert all(r["mse"] == r["mse"] for r in pairs.brute_force(df, "y", categorical=["x", "z"]).collect())


def test_sample_is_stable_and_stratified(df):
    keyed = df.withColumn("id", F.monotonically_increasing_id())
    args = ("id", ["c"], "size", {"s": 0.5}, ["c"])
    once = distribution.scatter_sample(keyed, *args)
    again = distribution.scatter_sample(keyed.repartition(7), *args)
    assert sorted(once.collect()) == sorted(again.collect())
    assert {r["size"] for r in once.collect()} == {"s"}
    assert once.count() == pytest.approx(keyed.where("size = 's'").count() * 0.5, rel=0.25)
