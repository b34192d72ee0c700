"""Databases, tables and temporary views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def database_names(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def table_names(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """(Re)build a Parquet table from a query and return the stored table.

    With a ``path`` the files go there and the catalog only points at them. Stored rows have
    no order; sort where the table is read.
    """
    drop_table(df.sparkSession, name)
    writer = df.write.format("parquet").mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_views(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
