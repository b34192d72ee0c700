"""Equal-width bins, closed on the right.

The bins split a column's observed range evenly; a value on an inner edge belongs to the bin
on its left. The first edge is lowered by a thousandth of the range so that the smallest
value has a bin. A constant column gets a thousandth of its value as room on either side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import clean_double

_MARGIN = 0.001


@dataclass(frozen=True)
class Range:
    """Even bins over ``[lo, hi]``; the first one is open down to ``floor``."""

    lo: float | None
    hi: float | None
    step: float | None
    floor: float | None
    bins: int

    @staticmethod
    def over(smallest: float | None, largest: float | None, bins: int) -> Range:
        if smallest is None or largest is None:
            return Range(None, None, None, None, bins)
        lo, hi = smallest, largest
        if lo == hi:
            room = _MARGIN if lo == 0.0 else abs(lo) * _MARGIN
            lo, hi = lo - room, hi + room
            floor = lo
        else:
            floor = lo - (hi - lo) * _MARGIN
        return Range(lo, hi, (hi - lo) / bins, floor, bins)

    def edges(self) -> list[tuple[int, float, float]]:
        """(bin, lower, upper) of every bin; none for a column without values."""
        if self.lo is None:
            return []
        inner = [self.lo + k * self.step for k in range(1, self.bins)]
        bounds = [self.floor, *inner, self.hi]
        return [(k, bounds[k], bounds[k + 1]) for k in range(self.bins)]


@dataclass(frozen=True)
class Overview:
    """One pass over a frame: the columns' ranges, the mean response and the row count."""

    ranges: list[Range]
    mean: float | None
    rows: int


def overview(
    df: DataFrame, columns: Sequence[str], bins: int = 10, response: str | None = None
) -> Overview:
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.lit(None).cast("double") if response is None else F.avg(response)).alias("mean"),
        *[F.min(clean_double(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(clean_double(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    ranges = [Range.over(facts[f"lo{i}"], facts[f"hi{i}"], bins) for i in range(len(columns))]
    return Overview(ranges, facts["mean"], facts["rows"])


def bin_by_edges(value: Column, r: Range) -> Column:
    """Index of the first bin whose upper edge is not below the value; NULL if missing."""
    if r.lo is None:
        return F.lit(None).cast("int")
    bins = r.edges()
    index = F.when(value.isNull(), F.lit(None).cast("int"))
    for k, _, upper in bins[:-1]:
        index = index.when(value <= F.lit(upper), F.lit(k))
    return index.otherwise(F.lit(bins[-1][0]))


def with_fine_bin(df: DataFrame, value: str, lo: Column, step: Column, bins: int,
                  alias: str) -> DataFrame:
    """The same index for many bins: a division, set right by the two nearest edges."""
    v = F.col(value)
    guess = F.greatest(
        F.lit(0), F.least(F.lit(bins - 1), F.ceil((v - lo) / step).cast("int") - 1)
    )
    g = F.col("__guess")
    settled = (
        F.when((g > 0) & (v <= F.col("__lo") + g * F.col("__step")), g - 1)
        .when((g < bins - 1) & (v > F.col("__lo") + (g + 1) * F.col("__step")), g + 1)
        .otherwise(g)
    )
    return (
        df.select("*", lo.alias("__lo"), step.alias("__step"), guess.alias("__guess"))
        .withColumn(alias, settled)
        .drop("__lo", "__step", "__guess")
    )


def binned(
    df: DataFrame,
    columns: Sequence[str],
    ranges: Sequence[Range],
    keep: Sequence[Column | str] = (),
) -> DataFrame:
    """``keep`` and ``bins``, an array of the columns' bin indexes."""
    values = df.select(*keep, *[clean_double(c).alias(f"__{c}") for c in columns])
    kept = values.columns[: len(keep)]
    return values.select(
        *kept,
        F.array(*[bin_by_edges(F.col(f"__{c}"), r) for c, r in zip(columns, ranges)]).alias(
            "bins"
        ),
    )


def bin_edges(df: DataFrame, columns: Sequence[str], ranges: Sequence[Range]) -> DataFrame:
    """The bins themselves: (name, bin, lower, upper, middle)."""
    rows = [
        (c, k, lower, upper, (lower + upper) / 2.0)
        for c, r in zip(columns, ranges)
        for k, lower, upper in r.edges()
    ]
    return df.sparkSession.createDataFrame(
        rows, "name string, bin int, lower double, upper double, middle double"
    )


def with_bins(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """The frame with a ``<column>_bin`` for each column."""
    indexed = binned(df, columns, overview(df, columns, bins).ranges, keep=df.columns)
    return indexed.select(
        *df.columns, *[F.col("bins")[i].alias(f"{c}_bin") for i, c in enumerate(columns)]
    )
