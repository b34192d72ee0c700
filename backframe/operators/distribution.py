"""Distributions and trends: histograms, density curves, quantiles and OLS."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import clean_double, pick
from backframe.operators.ranks import FAN, FEW, values_at_ranks
from backframe.session import small, stored


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    """(…keep, i, v) for every value present."""
    values = F.array(*[clean_double(c) for c in columns])
    return df.select(*keep, F.posexplode(values).alias("i", "v")).where(F.col("v").isNotNull())


def _narrow(df: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    """The kept columns and the values alone, written once: ranks are found in several passes.

    The values are named by their place; a join or a wide table behind ``df`` is worked on once.
    """
    return stored(df.select(*keep, *[clean_double(c).alias(f"x{i}") for i, c in enumerate(columns)]), "narrow")


def _class(name: str) -> Column:
    return F.col(name).cast("string").alias("class")


def class_histogram(
    df: DataFrame, columns: Sequence[str], by: str, width: float = 0.2
) -> DataFrame:
    """(name, class, bin, start, n, density) with bins counted from each class's minimum.

    The minima go to the rows, which are counted where they lie; only counts are exchanged.
    """
    rows = _long(df, columns, [_class(by)]).where(F.col("class").isNotNull())
    starts = stored(
        rows.groupBy("i", "class").agg(F.min("v").alias("lo"), F.count("v").alias("total")), "starts"
    )
    bins = (
        rows.join(small(starts), ["i", "class"])
        .groupBy("i", "class", F.floor((F.col("v") - F.col("lo")) / width).alias("bin"))
        .agg(F.count("v").alias("n"), F.first("lo").alias("lo"), F.first("total").alias("total"))
    )
    return bins.select(
        pick(list(columns), "i").alias("name"),
        "class",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("start"),
        "n",
        (F.col("n") / (F.col("total") * width)).alias("density"),
    )


def class_kde(
    df: DataFrame,
    columns: Sequence[str],
    by: str,
    points: int = 500,
    fineness: int = 256,
) -> DataFrame:
    """(name, class, point, x, density): Gaussian kernel density with Scott's bandwidth.

    The curve of a class runs from its smallest to its largest value. A class without spread
    has no curve. Values are summed in buckets of a class's own bandwidth over ``fineness``,
    each standing for the mean of its values, so what the buckets blur stays below the curve's
    own smoothing, wherever the column lies and whatever its range.
    """
    rows = _long(df, columns, [_class(by)]).where(F.col("class").isNotNull())
    shapes = rows.groupBy("i", "class").agg(
        F.count("v").alias("total"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        # Spark merges central moments, so values far from zero keep their spread.
        (F.stddev_samp("v") * F.pow(F.count("v"), F.lit(-0.2))).alias("h"),
    ).where(F.col("h") > 0)
    shapes = stored(shapes, "shapes")
    buckets = (
        rows.join(small(shapes.select("i", "class", F.col("lo").alias("from"), "h")), ["i", "class"])
        .groupBy("i", "class", F.floor((F.col("v") - F.col("from")) * fineness / F.col("h")).alias("bucket"))
        .agg(
            F.count("v").alias("n"),
            F.when(F.min("v") == F.max("v"), F.min("v"))
            .otherwise(F.min("v") + F.avg(F.col("v") - F.col("from")) - F.min(F.col("v") - F.col("from")))
            .alias("x"),
        )
    )
    grid = shapes.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).withColumn(
        "at", F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / float(points - 1)
    )
    z = (F.col("at") - F.col("x")) / F.col("h")
    # The grid goes to the buckets, so a class is spread over as many tasks as they are.
    return (
        buckets.select("i", "class", "n", "x").join(small(grid), ["i", "class"])
        .groupBy("i", "class", "point", "at", "h", "total")
        .agg(F.sum(F.col("n") * F.exp(-0.5 * z * z)).alias("mass"))
        .select(
            pick(list(columns), "i").alias("name"),
            "class",
            "point",
            F.col("at").alias("x"),
            (F.col("mass") / (F.col("total") * F.col("h") * math.sqrt(2 * math.pi))).alias(
                "density"
            ),
        )
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    fan: int = FAN,
    few: int = FEW,
) -> DataFrame:
    """(name, class, p, value): exact quantiles with linear interpolation, by class or overall.

    Buckets that hold wanted ranks are refined, for all columns and classes at once, until they
    hold a few values; no task sorts a column or keeps its distinct values, and a value far out
    makes no bucket hold the rest for long.
    """
    keep = F.lit("all").alias("class") if by is None else _class(by)
    return _quantiles(_narrow(df, columns, keep), columns, probabilities, fan, few)


def _named(narrow: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(class, i, v) of a narrow frame, rows without a class left out."""
    return _long(narrow, [f"x{i}" for i in range(len(columns))], ["class"]).where(F.col("class").isNotNull())


def _quantiles(
    narrow: DataFrame, columns: Sequence[str], probabilities: Sequence[float], fan: int = FAN, few: int = FEW
) -> DataFrame:
    rows = _named(narrow, columns).withColumn("n", F.lit(1).cast("long"))
    totals = rows.groupBy("i", "class").agg(F.sum("n").alias("total"))
    rank = F.col("p") * (F.col("total") - 1).cast("double")
    places = stored(
        totals.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")).select(
            "i", "class", "p", F.floor(rank).alias("low"), (rank - F.floor(rank)).alias("part"),
            F.least(F.floor(rank) + 1, F.col("total") - 1).alias("high"),
        ),
        "places",
    )
    keys = ["i", "class"]
    wanted = places.select(*keys, F.explode(F.array("low", "high")).alias("k")).distinct()
    found = values_at_ranks(rows, keys, wanted, fan, few)
    at = lambda name: found.select(*keys, F.col("k").alias(name), F.col("v").alias(f"{name}_v"))
    between = F.col("low_v") + (F.col("high_v") - F.col("low_v")) * F.col("part")
    return places.join(at("low"), [*keys, "low"]).join(at("high"), [*keys, "high"]).select(
        pick(list(columns), "i").alias("name"), "class", "p", between.alias("value")
    )


def box_summary(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(name, class, n, lo, q1, median, q3, hi) for a box or violin per class."""
    narrow = _narrow(df, columns, _class(by))
    ends = (
        _named(narrow, columns)
        .groupBy(pick(list(columns), "i").alias("name"), "class")
        .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    at = _quantiles(narrow, columns, [0.25, 0.5, 0.75])
    quartiles = at.groupBy("name", "class").agg(
        *[
            F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
            for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ]
    )
    return ends.join(quartiles, ["name", "class"]).select(
        "name", "class", "n", "lo", "q1", "median", "q3", "hi"
    )


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, mean, min, max, median) of each column; the median is exact."""
    narrow = _narrow(df, columns, F.lit("all").alias("class"))
    moments = (
        _named(narrow, columns)
        .groupBy(pick(list(columns), "i").alias("name"))
        .agg(F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))
    )
    medians = _quantiles(narrow, columns, [0.5]).select("name", F.col("value").alias("median"))
    return moments.join(medians, "name")


def ols_trend(df: DataFrame, columns: Sequence[str], response: str) -> DataFrame:
    """(name, slope, intercept, r2) of the least-squares line through each predictor."""
    y = clean_double(response).alias("y")
    return (
        _long(df, columns, [y])
        .where(F.col("y").isNotNull())
        .groupBy("i")
        .agg(
            F.regr_slope("y", "v").alias("slope"),
            F.regr_intercept("y", "v").alias("intercept"),
            F.regr_r2("y", "v").alias("r2"),
        )
        .select(pick(list(columns), "i").alias("name"), "slope", "intercept", "r2")
    )


def scatter_sample(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    by: str,
    fractions: dict[str, float],
    log_columns: Sequence[str] = (),
) -> DataFrame:
    """A sample of points to draw, stratified by class; ``log_columns`` gain a log10 twin.

    A row's fate hangs on a digest of its key, so the sample is the same on every run and
    after the loss of an executor. Classes without a fraction are not drawn.
    """
    draw = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("double")
    share = F.lit(0.0)
    for level, fraction in fractions.items():
        share = F.when(F.col(by) == level, F.lit(float(fraction))).otherwise(share)
    logs = [
        F.when(F.col(c) > 0, F.log10(F.col(c).cast("double"))).alias(f"log10_{c}")
        for c in log_columns
    ]
    return df.where(draw < share * 4294967296.0).select(key, by, *columns, *logs)
