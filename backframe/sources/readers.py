"""Table, text and database readers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class JdbcSplit:
    """How to read a table with several tasks: ranges of a numeric or date column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    split: JdbcSplit | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetch_size),
    }
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def jdbc_reader(spark: SparkSession, **kwargs) -> DataFrameReader:
    """A reader set up for one table; ``load()`` it. Arguments as for ``jdbc_options``.

    Without a ``split`` the table comes through a single task, which suits small tables only.
    """
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs))


def read_positional_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, separator: str = ","
) -> DataFrame:
    """A text table without header line; names and types come from ``schema`` by position.

    Lines that are blank or hold no value at all are left out.
    """
    rows = spark.read.schema(schema).csv(path, header=False, sep=separator)
    return rows.na.drop("all")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming the columns an inferred schema lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
