"""Joins, grouped aggregates and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import ratio
from backframe.session import stored


def grouped_ratio(
    df: DataFrame,
    keys: Sequence[str | Column],
    numerator: str,
    denominator: str,
    alias: str = "ratio",
) -> DataFrame:
    """Ratio of sums per group, 0 where the denominator sums to 0."""
    return df.groupBy(*keys).agg(
        ratio(F.sum(numerator), F.sum(denominator)).alias(alias)
    )


def pair_rows(
    df: DataFrame,
    game: str,
    team: str,
    side: Column,
    first: Mapping[str, str],
    second: Mapping[str, str],
    exactly_two: bool = False,
) -> DataFrame:
    """One row per game from its two team rows.

    ``side`` is true on the row that comes first. ``first`` and ``second`` map output names
    to columns of the respective row. In general every first-side row is joined with each
    row of another team in its game. With ``exactly_two`` the caller vouches for two rows
    per game, and a single aggregation replaces the join.
    """
    if exactly_two:
        return df.groupBy(game).agg(
            *[F.max(F.when(side, F.col(c))).alias(out) for out, c in first.items()],
            *[F.max(F.when(~side, F.col(c))).alias(out) for out, c in second.items()],
        )
    left = df.where(side).select(
        game, F.col(team).alias("__team"), *[F.col(c).alias(out) for out, c in first.items()]
    )
    right = df.select(
        game, F.col(team).alias("__other"), *[F.col(c).alias(out) for out, c in second.items()]
    )
    return left.join(right, game).where(F.col("__team") != F.col("__other")).drop(
        "__team", "__other"
    )


def pivot_flag(
    df: DataFrame, key: str, flag: str, value: str, outputs: Mapping[object, str]
) -> DataFrame:
    """Values of ``flag`` turned into columns; NULL where a key lacks one."""
    return df.groupBy(key).agg(
        *[F.max(F.when(F.col(flag) == v, F.col(value))).alias(out) for v, out in outputs.items()]
    )


def long_form(df: DataFrame, ids: Sequence[str], values: Sequence[str],
              name: str = "name", value: str = "value") -> DataFrame:
    """Wide to long; missing cells are left out."""
    return df.unpivot(list(ids), list(values), name, value).where(F.col(value).isNotNull())


def wide_form(
    df: DataFrame, index: str, columns: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Long to wide over a known list of column names."""
    return df.groupBy(index).pivot(columns, list(names)).agg(F.first(value))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Violations of a uniqueness constraint: keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def contingency(df: DataFrame, predictor: str, response: str, spread: int = 64) -> DataFrame:
    """Counts of predictor label x response label over the union of both label sets.

    Labels compare as text. The full square has (number of labels)^2 cells, so it is meant
    for categories; ``observed_cells`` gives the cells that occur, however many labels there are.
    The square is dealt in ``spread`` parts of the second label, each met by all first ones.
    """
    cells = stored(observed_cells(df, predictor, response), "cells")
    labels = cells.select(F.explode(F.array("x", "y")).alias("label")).distinct()
    first = labels.select(F.col("label").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
    second = labels.select(F.col("label").alias("y"), F.pmod(F.xxhash64("label"), F.lit(spread)).cast("int").alias("part"))
    square = first.join(second, "part").select("x", "y")
    return square.join(cells, ["x", "y"], "left").select(
        "x", "y", F.coalesce("n", F.lit(0)).alias("n")
    )


def observed_cells(df: DataFrame, predictor: str, response: str) -> DataFrame:
    """Only the label combinations that occur, with their counts."""
    return (
        df.select(F.col(predictor).cast("string").alias("x"),
                  F.col(response).cast("string").alias("y"))
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
