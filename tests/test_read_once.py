"""Inputs that are costly to make are made once, however many passes an operator takes."""

import numpy as np
import pandas as pd
import pytest

from backframe.operators import distribution, models, selection
from backframe.session import stored

ROWS = 600


@pytest.fixture
def costly(spark, tmp_path):
    """A frame that notes each batch it hands out, and how many rows it has handed out so far."""
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"a": rng.normal(size=ROWS), "b": rng.uniform(size=ROWS), "y": rng.integers(0, 2, ROWS)})
    log = str(tmp_path / "handed-out")

    def noted(batches):
        for batch in batches:
            with open(log, "a") as f:
                f.write(f"{len(batch)}\n")
            yield batch

    def handed_out():
        with open(log) as f:
            return sum(map(int, f))

    return spark.createDataFrame(frame).mapInPandas(noted, "a double, b double, y long"), handed_out


def test_box_summary(costly):
    df, handed_out = costly
    assert distribution.box_summary(df, ["a", "b"], "y").count() == 4
    assert handed_out() == ROWS


def test_column_summary(costly):
    df, handed_out = costly
    assert distribution.column_summary(df, ["a", "b"]).count() == 2
    assert handed_out() == ROWS


def test_quantiles(costly):
    df, handed_out = costly
    assert distribution.quantiles(df, ["a", "b"], [0.1, 0.9], "y").count() == 8
    assert handed_out() == ROWS


def test_importance_and_feature_summary(costly):
    df, handed_out = costly
    assert models.forest_importance(df, ["a", "b"], "y", trees=2, max_depth=3).count() == 2
    assert handed_out() == ROWS
    assert selection.feature_summary(df, ["a", "b"], "y", trees=2).count() == 2
    assert handed_out() == 2 * ROWS


def test_rows_stored_before_are_not_stored_again(costly, monkeypatch):
    df, handed_out = costly
    written = []
    for module in (models, selection):
        monkeypatch.setattr(module, "stored", lambda frame, name: written.append(name) or stored(frame, name))
    got = selection.feature_summary(df, ["a", "b"], "y", trees=2)
    assert written == ["summary-rows"] and handed_out() == ROWS
    shares = {r["name"]: r["importance"] for r in got.collect()}
    assert sum(shares.values()) == pytest.approx(1.0)
