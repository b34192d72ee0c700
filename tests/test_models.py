import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from backframe.operators import models, neighbours, regression, selection
from tests.conftest import as_dicts


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 400
    x = rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-0.8 * x))).astype(int)
    return [
        (i, float(x[i]) * 30 + 5, float(rng.normal()), float(x[i]), 1.0, float(y[i]), int(y[i]))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def df(spark, rows):
    schema = "id long, good double, noise double, twin double, flat double, same double, y int"
    return spark.createDataFrame(rows, schema).cache()


def test_logit_agrees_with_glm(df):
    got = as_dicts(regression.logit_univariate(df, ["good", "noise", "flat", "same"], "y"), "name")
    for c in ("good", "noise"):
        data = models.assembler([c]).transform(df)
        fit = GeneralizedLinearRegression(
            family="binomial", labelCol="y", maxIter=50, tol=1e-12
        ).fit(data)
        assert got[c]["coefficient"] == pytest.approx(fit.coefficients[0], rel=1e-6)
        assert got[c]["z_value"] == pytest.approx(fit.summary.tValues[0], rel=1e-6)
        assert got[c]["p_value"] == pytest.approx(fit.summary.pValues[0], rel=1e-6)
    for c in ("flat", "same"):  # no spread; separates the response
        assert got[c]["z_value"] is None and got[c]["p_value"] is None
    assert {c: r["status"] for c, r in got.items()} == {
        "good": "converged", "noise": "converged", "flat": "no spread", "same": "not converged",
    }


def test_logit_leaves_out_missing_values(df):
    holes = df.withColumn("good", F.when(F.col("id") % 5 > 0, F.col("good")))
    got = regression.logit_univariate(holes, ["good"], "y").first()
    want = regression.logit_univariate(df.where("id % 5 > 0"), ["good"], "y").first()
    assert got["n"] == 320 and got["z_value"] == pytest.approx(want["z_value"], abs=1e-9)


def test_summary_and_pruning(df):
    columns = ["good", "noise", "twin"]
    summary = selection.feature_summary(df, columns, "y", trees=5)
    got = as_dicts(summary, "name")
    assert set(got) == set(columns)
    assert sum(r["importance"] for r in got.values()) == pytest.approx(1.0)
    kept = as_dicts(selection.prune_correlated(df, columns, summary), "name")
    assert kept["noise"]["kept"]
    assert kept["good"]["kept"] != kept["twin"]["kept"]  # one is a multiple of the other
    left = {r["name"] for r in selection.prune_weak(summary, least_importance=1.0).collect()}
    assert left == {c for c in columns if got[c]["p_value"] <= 0.05}
    printed = as_dicts(selection.printed_statistics(summary), "name")
    assert printed["noise"]["p_value"] == f"{got['noise']['p_value']:.6e}"


def test_standardize_uses_the_population_deviation(df):
    out = models.standardize(df, ["good", "flat"])
    r = out.agg(F.avg("good"), F.stddev_pop("good"), F.max(F.abs("flat"))).first()
    assert r[0] == pytest.approx(0, abs=1e-9) and r[1] == pytest.approx(1) and r[2] == 0


def test_label_codes_follow_the_alphabet(spark):
    df = spark.createDataFrame([("pear",), ("apple",), ("plum",), ("apple",)], "fruit string")
    coded, model = models.label_codes(df, "fruit", "code")
    assert {r["fruit"]: r["code"] for r in coded.collect()} == {"apple": 0, "pear": 1, "plum": 2}
    back = models.code_labels(coded, "code", "again", model)
    assert back.where("again <> fruit").count() == 0


def test_logistic_penalty(df, rows):
    """The gradient of the penalised loss vanishes at the fitted coefficients."""
    model = models.fit_logistic(df, ["noise", "twin"], "y", strength=0.05).stages[-1]
    x = np.array([[r[2], r[3]] for r in rows])
    y = np.array([r[6] for r in rows])
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(w + 0.05 * x.T @ (p - y)).max() < 1e-2


def test_forests_learn(df):
    for fit in (models.fit_forest, models.fit_scaled_forest):
        scored = fit(df, ["good", "noise"], "y", trees=10).transform(df)
        assert models.accuracy(scored, "prediction", "y").first()["accuracy"] > 0.65


def test_f_scores(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (2, 1)], "p int, y int")
    got = as_dicts(models.f_scores(df, "p", "y"), "class")
    assert (got[0]["precision"], got[0]["recall"]) == (1.0, pytest.approx(2 / 3))
    assert (got[1]["precision"], got[1]["recall"], got[1]["f_score"]) == (0.5, 0.5, 0.5)
    assert (got[2]["support"], got[2]["f_score"]) == (0, 0.0)


@pytest.mark.parametrize("pivots,block", [(1, 1024), (8, 16), (300, 7)])
def test_neighbours_against_brute_force(spark, pivots, block):
    """Clustered points with many equal distances; a third of them are one and the same."""
    rng = np.random.default_rng(2)
    points = [
        (i, [0.0, 0.0] if i % 3 == 0 else [float(v) for v in rng.integers(0, 12, 2)], i % 4)
        for i in range(180)
    ]
    df = spark.createDataFrame(points, "id long, v array<double>, label int")
    ask = df.where("id % 2 = 0")
    got = neighbours.nearest_neighbours(df, ask, "id", "v", "label", k=5, pivots=pivots, block=block)
    found = {}
    for r in got.orderBy("query", "rank").collect():
        found.setdefault(r["query"], []).append(r["neighbour"])
    votes = as_dicts(
        neighbours.knn_classify(df, ask, "id", "v", "label", k=5, pivots=pivots, block=block), "id"
    )
    for i, v, _ in points[::2]:
        order = sorted(points, key=lambda p: (math.dist(p[1], v), p[0]))[:5]
        assert found[i] == [p[0] for p in order]
        labels = [p[2] for p in order]
        assert votes[i]["prediction"] == min(set(labels), key=lambda c: (-labels.count(c), c))


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e300])
def test_nearest_rows_are_those_of_all_distances(offset):
    rng = np.random.default_rng(3)
    b = np.concatenate([rng.normal(size=(3000, 16)), np.zeros((40, 16)), rng.normal(size=(1, 16)).repeat(30, axis=0)]) + offset
    a = np.concatenate([b[::50], rng.normal(size=(50, 16)) + offset])
    places, reach = neighbours._nearest(a, b, 7)
    d = neighbours._distances(a, b)
    best = np.argsort(d, axis=1, kind="stable")[:, :7]
    assert (places == best).all() and (reach == np.take_along_axis(d, best, axis=1)).all()


def test_rows_near_many_pivots_are_sent_in_small_batches(spark, monkeypatch):
    """Vectors of many dimensions lie near all cells; what a worker sends at once stays bounded."""
    rng = np.random.default_rng(8)
    points = rng.normal(size=(2000, 64))
    batch = pd.DataFrame({"id": range(2000), "vector": list(points), "label": 0})
    df = spark.createDataFrame([(i, points[i].tolist(), 0) for i in range(300)], "id long, v array<double>, label int")
    functions = []
    real = type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, f, *a: functions.append(f) or real(self, f, *a))
    neighbours.nearest_neighbours(df, df, "id", "v", "label", k=3, pivots=32)
    sent = [len(out) for out in functions[2](iter([batch]))]
    assert sum(sent) > 2000 * 16 and max(sent) <= 8192
