"""Approximate neighbours: recall against the exact form, ties, crowds and small tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from backframe.operators.neighbours import nearest_neighbours
from backframe.operators.projections import Tables, approximate_neighbours, recall
from backframe.plans.tables import load


def vectors(spark, rows, labels=None):
    labels = labels if labels is not None else ["x"] * len(rows)
    frame = pd.DataFrame({"id": range(len(rows)), "v": [r.tolist() for r in rows], "label": labels})
    return spark.createDataFrame(frame)


@pytest.mark.parametrize("dimensions", [8, 64])
def test_recall(spark, dimensions):
    rng = np.random.default_rng(13)
    centres = rng.normal(size=(40, dimensions)) * 3
    df = vectors(spark, centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, dimensions)))
    asked = df.where("id % 20 = 0")
    found = approximate_neighbours(df, asked, "id", "v", "label")
    exact = nearest_neighbours(df, asked, "id", "v", "label")
    got = recall(found, exact).first()
    assert got["n"] == 150 * 7 and got["recall"] >= 0.9
    assert found.groupBy("query").count().where("count <> 7").count() == 0


def test_given_embeddings(spark, sf_dir):
    df = load(spark, sf_dir, "embeddings")
    asked = df.where("vec_id % 20 = 0")
    args = (df, asked, "vec_id", "embedding", "label")
    assert recall(approximate_neighbours(*args), nearest_neighbours(*args)).first()["recall"] >= 0.9


def test_a_crowd_of_equal_vectors_and_lonely_queries(spark):
    rng = np.random.default_rng(14)
    rows = np.concatenate([np.zeros((2500, 4)), rng.normal(size=(300, 4)) * 5])
    df = vectors(spark, rows, ["crowd"] * 2500 + ["other"] * 300)
    far = spark.createDataFrame([(9001, [1e6] * 4), (9002, [0.0] * 4)], "id long, v array<double>")
    got = approximate_neighbours(df, far, "id", "v", "label", 5, Tables(block=64)).collect()
    exact = nearest_neighbours(df, far, "id", "v", "label", 5).collect()
    assert sorted((r["query"], r["rank"], r["neighbour"]) for r in got) == sorted((r["query"], r["rank"], r["neighbour"]) for r in exact)
    assert [r["neighbour"] for r in sorted(got, key=lambda r: r["rank"]) if r["query"] == 9002] == [0, 1, 2, 3, 4]


def test_fewer_rows_than_asked_for(spark):
    df = vectors(spark, np.arange(6).reshape(3, 2).astype(float), ["a", "b", "c"])
    got = approximate_neighbours(df, df, "id", "v", "label", 7).collect()
    assert len(got) == 9 and {r["label"] for r in got if r["rank"] == 1} == {"a", "b", "c"}
    assert approximate_neighbours(df, df.where(F.lit(False)), "id", "v", "label", 7).count() == 0
