"""Named data sets: how to prepare each, and which columns predict which response."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import threshold_flag
from backframe.operators.prepare import drop_null_rows


@dataclass(frozen=True)
class Dataset:
    response: str
    predictors: tuple[str, ...] | None = None  # None: every column but the response
    prepare: tuple[Callable[[DataFrame], DataFrame], ...] = field(default=())


# Predictors and responses of the well-known sample sets.
_TITANIC = ("pclass", "sex", "age", "sibsp", "embarked", "parch", "fare", "who", "adult_male",
            "deck", "embark_town", "alone", "class")

_REGISTRY: dict[str, Dataset] = {
    "mpg": Dataset(
        "mpg",
        ("cylinders", "displacement", "horsepower", "weight", "acceleration", "origin"),
        (drop_null_rows, lambda df: df.drop("name")),
    ),
    "tips": Dataset(
        "tip", ("total_bill", "sex", "smoker", "day", "time", "size"), (drop_null_rows,)
    ),
    "titanic": Dataset("survived", _TITANIC, (drop_null_rows,)),
    "titanic_2": Dataset("alive", _TITANIC, (drop_null_rows,)),
    "boston": Dataset(
        "target", prepare=(lambda df: df.withColumn("CHAS", F.col("CHAS").cast("string")),)
    ),
    "diabetes": Dataset(
        "target", prepare=(lambda df: df.withColumn("gender", threshold_flag("sex")),)
    ),
    "breast_cancer": Dataset("target"),
}


def register_dataset(name: str, dataset: Dataset) -> None:
    _REGISTRY[name] = dataset


def dataset_names() -> list[str]:
    return sorted(_REGISTRY)


def load_dataset(
    name: str, read: Callable[[], DataFrame]
) -> tuple[DataFrame, list[str], str]:
    """``(data, predictors, response)`` of a registered set; ``read`` supplies its raw rows."""
    if name not in _REGISTRY:
        raise ValueError(f"unknown data set: {name}")
    entry = _REGISTRY[name]
    df = read()
    columns = [c for c in df.columns if c != entry.response]
    for step in entry.prepare:
        df = step(df)
    predictors = list(entry.predictors) if entry.predictors is not None else columns
    return df, predictors, entry.response
