"""Stored frames and published results: what is left, and what a failed run leaves."""

import os
import re

import pytest
from pyspark.sql import functions as F

from backframe.operators import distribution, lowess
from backframe.session import publish, scratch_run, shared_folder, stored


def folders(spark):
    """Ours among the folders there; Spark makes some of its own."""
    names = os.listdir(shared_folder(spark).removeprefix("file://"))
    return {n for n in names if re.search("-[0-9a-f]{32}$", n)}


def test_nothing_of_a_run_remains_but_its_result(spark, tmp_path):
    before = folders(spark)
    df = spark.range(500).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("y"))
    with scratch_run(spark) as made:
        publish(distribution.quantiles(df, ["a"], [0.5], "y"), str(tmp_path / "quantiles"))
        publish(lowess.lowess_trend(df, ["a"], "y", rounds=1), str(tmp_path / "trend"))
        assert len(made) > 8 and folders(spark) > before
    assert folders(spark) == before
    assert sorted(os.listdir(tmp_path)) == ["quantiles", "trend"]
    assert spark.read.parquet(str(tmp_path / "trend")).count() == 500


def test_a_failed_run_leaves_the_old_result_and_may_be_repeated(spark, tmp_path):
    path = str(tmp_path / "result")
    publish(spark.range(3), path)
    before = folders(spark)
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"), scratch_run(spark):
        stored(spark.range(9), "kept")
        publish(broken, path)
    assert folders(spark) == before and os.listdir(tmp_path) == ["result"]
    assert spark.read.parquet(path).count() == 3
    publish(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and os.listdir(tmp_path) == ["result"]


def test_nested_runs_remove_their_own(spark):
    with scratch_run(spark) as outer:
        kept = stored(spark.range(4), "outer")
        with scratch_run(spark) as inner:
            stored(spark.range(5), "inner")
        assert len(outer) == len(inner) == 1 and kept.count() == 4
