"""Reading the corpus tables, and what several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from backframe.session import ship_package

#: The white space that parts words, space and \t to \r.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Bytes that one Arrow batch may hold on its way to a Python worker.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP, -1), lambda w: w != "")


def python_ready(spark: SparkSession) -> None:
    """Workers can import the package, and Arrow batches are bounded in bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh_name(frame: DataFrame, wanted: str) -> str:
    """A column name that the frame does not use, whatever its letter case."""
    used = {c.lower() for c in frame.columns}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def without(frame: DataFrame, names: list[str]) -> DataFrame:
    """The frame without columns that an operator is about to add under the same names."""
    taken = {n.lower() for n in names}
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c.lower() not in taken])


def texts_of(batch: pd.DataFrame, column: str) -> list[str]:
    return [t if isinstance(t, str) else "" for t in batch[column]]


def whole_partition(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    """All rows of a partition, whose size the caller has bounded; None if there are none."""
    parts = [b for b in batches if len(b)]
    return pd.concat(parts, ignore_index=True) if parts else None


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def settled(frame: DataFrame, name: str, *fields: Column) -> DataFrame:
    """The frame with a struct of costly fields that is worked out once per row.

    Left to itself, the optimizer puts the expression in place of every later use, inside
    higher-order functions and pushed-down filters too. The row generated here stays as it is.
    """
    kept = [F.col(f"`{c}`") for c in frame.columns if c.lower() != name.lower()]
    return frame.select(*kept, F.explode(F.array(F.struct(*fields))).alias(name))


def let_go() -> None:
    """Give memory that a task no longer needs back to the system.

    Python workers outlive their tasks and stand beside the executor's heap; what Arrow and the C
    library keep for reuse would count against the stages that follow.
    """
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)
