"""Report output: ranked result tables as one long frame, or as files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, score: str, ties: Sequence[str]) -> DataFrame:
    """Rows of a small result table in descending order of score, with their rank."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col(score).desc_nulls_last(), *ties)
    return df.withColumn("rank", F.row_number().over(order))


def report(sections: Mapping[str, tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """Sections stacked as (section, rank, item, score).

    Each section is (result table, its label columns, its score column).
    """
    parts = [
        ranked(df, score, labels).select(
            F.lit(name).alias("section"),
            "rank",
            F.concat_ws(" x ", *labels).alias("item"),
            F.col(score).cast("double").alias("score"),
        )
        for name, (df, labels, score) in sections.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def write_report(df: DataFrame, path: str, file_format: str = "json") -> None:
    """One folder per section."""
    df.write.mode("overwrite").partitionBy("section").format(file_format).save(path)
