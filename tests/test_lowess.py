"""LOWESS against a plain fit, row by row."""

import numpy as np
import pandas as pd
import pytest

import backframe.operators.lowess as lowess
from backframe.session import stored


def plain_lowess(x, y, share, rounds):
    """{x: fit}, with no counting of equal points and no slope where the window has no spread."""
    n, trust = len(x), np.ones(len(x))
    k = min(max(int(share * n + 1e-10), 2), n)
    for turn in range(rounds + 1):
        fit = np.empty(n)
        for i in range(n):
            d = np.abs(x - x[i])
            h = np.sort(d)[k - 1]
            w = np.clip(1 - (d / h) ** 3, 0, None) ** 3 * trust if h > 0 else (d == 0) * trust
            if not w.sum() > 0:
                fit[i] = np.nan
                continue
            m, v = np.average(x, weights=w), np.average(y, weights=w)
            spread = (w * (x - m) ** 2).sum()
            slope = (w * (x - m) * y).sum() / spread if h > 0 and spread > 1e-12 * w.sum() * h**2 else 0.0
            fit[i] = v + slope * (x[i] - m)
        if turn == rounds:
            break
        r = np.abs(y - fit)
        s = 6 * np.median(r[~np.isnan(r)])
        if not s > 0:
            break
        trust = np.where(r < s, (1 - (r / s) ** 2) ** 2, 0)
    return dict(zip(x, fit, strict=True))


def made(spark, x, y, **options):
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    return {r["x"]: r["fit"] for r in lowess.lowess_trend(df, ["x"], "y", **options).collect()}


def agree(got, want, tolerance=1e-7):
    assert set(got) == set(want)
    for x, fit in want.items():
        if np.isnan(fit):
            assert got[x] is None
        else:
            assert got[x] == pytest.approx(fit, rel=tolerance, abs=tolerance)


def shapes():
    rng = np.random.default_rng(2)
    even = rng.uniform(0, 10, 500)
    clusters = np.concatenate([rng.normal(0, 1, 250), rng.normal(1000, 3, 250)])
    yield "even", even
    yield "clusters", clusters
    yield "heavy", np.concatenate([np.repeat(3.0, 300), rng.exponential(2, 200)])
    yield "steps", rng.integers(0, 40, 500).astype(float)
    yield "skewed", np.exp(rng.normal(0, 4, 500))


@pytest.mark.parametrize(("share", "rounds", "chunk"), [(2 / 3, 3, 8192), (2 / 3, 0, 20), (0.1, 1, 15), (1.0, 0, 50)])
def test_like_a_plain_fit(spark, share, rounds, chunk):
    rng = np.random.default_rng(3)
    frames, want = [], {}
    for name, x in shapes():
        y = np.sin(x / 3) + rng.normal(0, 0.3, len(x))
        frames.append(pd.DataFrame({name: x, "y": y}))
        want[name] = plain_lowess(x, y, share, rounds)
    df = spark.createDataFrame(pd.concat(frames))
    got = {name: {} for name in want}
    for r in lowess.lowess_trend(df, list(want), "y", share, rounds, chunk).collect():
        got[r["name"]][r["x"]] = r["fit"]
    for name in want:
        agree(got[name], want[name])


def test_a_value_far_out_moves_nothing_else(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.uniform(0, 1, 4000), [1e9]])
    y = np.concatenate([3 * x[:-1] + rng.normal(0, 0.1, 4000), [0.0]])
    with_it = made(spark, x, y, share=0.3, rounds=1, chunk=300)
    without = made(spark, x[:-1], y[:-1], share=0.3, rounds=1, chunk=300)
    assert len(with_it) == 4001
    at = np.array(sorted(without))
    inner = at[(at > 0.05) & (at < 0.6)]
    assert max(abs(with_it[v] - without[v]) for v in inner) < 1e-2
    agree(with_it, plain_lowess(x, y, 0.3, 1), 1e-6)


def test_no_task_has_a_whole_column(spark, monkeypatch):
    """A chunk is fitted from a few chunks, whatever the column's length."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, 6000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": x**2}))
    seen = []
    real = lowess.small
    monkeypatch.setattr(lowess, "small", lambda f: seen.append(f.groupBy("of").count().toPandas()["count"]) or real(f))
    got = lowess.lowess_trend(df, ["x"], "y", 0.3, 0, 100).collect()
    assert len(got) == 6000
    assert len(seen[0]) >= 60 and seen[0].max() <= 12


def test_missing_values_and_tiny_columns(spark):
    rows = [(1.0, 2.0, None, 1), (2.0, None, None, 0), (None, 2.0, None, 1), (4.0, 2.0, None, None), (4.0, 2.0, None, 1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    got = {(r["name"], r["x"]): r["fit"] for r in lowess.lowess_trend(df, ["a", "b", "c"], "y").collect()}
    assert set(got) == {("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 2.0)}
    assert got["b", 2.0] == pytest.approx(1.0)
    assert lowess.lowess_trend(df.limit(0), ["a"], "y").count() == 0
    assert lowess.lowess_trend(df, ["c"], "y").count() == 0


def test_rounds_join_no_levels_and_make_only_the_sums_asked_for(spark, monkeypatch):
    plans = []

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(lowess, "stored", seen)
    df = spark.createDataFrame([(float(i % 400), float(i % 7)) for i in range(1200)], "x double, y double")
    curve = lowess.lowess_trend(df, ["x"], "y", rounds=2, chunk=64)
    assert curve.count() == 400
    sums = [plan for name, plan in plans if name == "level-sums"]
    assert len(sums) == 3 and not any("Join" in plan for plan in sums)
    part = lowess.Part(np.array([1.0, 2.0, 4.0]), (np.ones(3), np.arange(3.0)))
    assert part.upto[0][-1, 0] == 3.0 and "on" not in vars(part)
    assert part.on[1][0, 0] == 3.0 and part.on[1][-1, 0] == 0.0
