"""Correlation of predictors: Pearson, correlation ratio, Cramer's V.

All pairs of columns are measured in one job. Each row becomes (column position, value)
pairs inside the task, and map-side aggregation reduces them to a few sums per pair before
anything is shuffled; what crosses the network grows with the number of pairs and categories,
not with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import clean_double, pick


def exploded_pairs(
    df: DataFrame, values: Column, keep: Sequence[Column | str] = (), diagonal: bool = False
) -> DataFrame:
    """(i, a, j, b) for every pair of positions i < j (i <= j) of an array column."""
    # The outer form keeps Spark from guarding against empty arrays, which would compute the
    # array expression a second time below the explode.
    first = df.select(*keep, values.alias("__v")).select(
        "*", F.posexplode_outer("__v").alias("i", "a")
    ).where(F.col("a").isNotNull())
    start = F.col("i") + (1 if diagonal else 2)
    rest = F.slice("__v", start, F.greatest(F.size("__v") - start + 1, F.lit(0)))
    kept = first.columns[: len(keep)]
    return (
        first.select(*kept, "i", "a", F.posexplode(rest).alias("__k", "b"))
        .where(F.col("b").isNotNull())
        .withColumn("j", F.col("__k") + F.col("i") + F.lit(0 if diagonal else 1))
        .drop("__k")
    )


def _mirrored(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Both triangles and the diagonal from the pairs i <= j of a small result."""
    both = df.select(
        F.explode(
            F.when(
                F.col("i") != F.col("j"),
                F.array(
                    F.struct(F.col("i").alias("p"), F.col("j").alias("q")),
                    F.struct(F.col("j").alias("p"), F.col("i").alias("q")),
                ),
            ).otherwise(F.array(F.struct(F.col("i").alias("p"), F.col("j").alias("q"))))
        ).alias("pq"),
        "value",
    )
    return both.select(
        pick(list(names), "pq.p").alias("x1"), pick(list(names), "pq.q").alias("x2"), "value"
    )


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x1, x2, value) over all ordered pairs, from pairwise complete rows.

    A pair with a constant column has no correlation and is left out.
    """
    values = F.array(*[clean_double(c) for c in columns])
    spread = F.stddev_pop("a") * F.stddev_pop("b")
    sums = (
        exploded_pairs(df, values, diagonal=True)
        .groupBy("i", "j")
        .agg(F.try_divide(F.covar_pop("a", "b"), spread).alias("value"))
        .where(F.col("value").isNotNull())
    )
    return _mirrored(sums, columns)


def correlation_ratio(
    df: DataFrame, categorical: Sequence[str], continuous: Sequence[str]
) -> DataFrame:
    """(x1, x2, value): how much of a number's spread lies between a category's levels.

    Rows without a category are no level, yet their values stay in the total spread.
    """
    levels = F.array(*[F.col(c).cast("string") for c in categorical])
    values = F.array(*[clean_double(c) for c in continuous])
    per_level = (
        df.select(levels.alias("__l"), values.alias("__v"))
        .select("__v", F.posexplode("__l").alias("i", "level"))
        .select("i", "level", F.posexplode("__v").alias("j", "v"))
        .where(F.col("v").isNotNull())
        .groupBy("i", "j", "level")
        .agg(
            F.count("v").alias("n"),
            F.avg("v").alias("m"),
            (F.var_pop("v") * F.count("v")).alias("q"),
        )
    )
    known = F.col("level").isNotNull()
    centres = per_level.where(known).groupBy("i", "j").agg(
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("c")
    )
    off = F.col("n") * (F.col("m") - F.col("c")) * (F.col("m") - F.col("c"))
    sums = (
        per_level.join(centres, ["i", "j"])
        .groupBy("i", "j")
        .agg(
            F.sum(F.when(known, off)).alias("explained"),
            F.sum(F.col("q") + off).alias("spread"),
            F.sum(F.col("n") * F.col("c") * F.col("c")).alias("size"),
        )
    )
    # A spread as small as rounding leaves it in a constant column is none.
    none = (F.col("explained") == 0.0) | (F.col("spread") <= 1e-24 * F.col("size"))
    eta = F.when(none, F.lit(0.0)).otherwise(
        F.sqrt(F.least(F.try_divide(F.col("explained"), F.col("spread")), F.lit(1.0)))
    )
    return sums.select(
        pick(list(categorical), "i").alias("x1"),
        pick(list(continuous), "j").alias("x2"),
        eta.alias("value"),
    )


def cramers_v(
    df: DataFrame, columns: Sequence[str], bias_correction: bool = True
) -> DataFrame:
    """(x1, x2, value) over all ordered pairs of categories.

    With ``bias_correction`` the value is Bergsma's corrected one (2013). A pair with a
    single-level column has no association and is left out.
    """
    levels = F.array(*[F.col(c).cast("string") for c in columns])
    cells = (
        exploded_pairs(df, levels, diagonal=True)
        .groupBy("i", "j", "a", "b")
        .agg(F.count(F.lit(1)).cast("double").alias("o"))
    )
    rows = cells.groupBy("i", "j", "a").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("i", "j", "b").agg(F.sum("o").alias("c"))
    sizes = rows.groupBy("i", "j").agg(
        F.sum("r").alias("n"), F.count(F.lit(1)).cast("double").alias("n_rows")
    ).join(cols.groupBy("i", "j").agg(F.count(F.lit(1)).cast("double").alias("n_cols")), ["i", "j"])
    shares = (
        cells.join(rows, ["i", "j", "a"])
        .join(cols, ["i", "j", "b"])
        .groupBy("i", "j")
        .agg(F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("share"))
        .join(sizes, ["i", "j"])
    )
    phi2 = F.greatest(F.col("share") - 1.0, F.lit(0.0))
    r, k, n = F.col("n_rows"), F.col("n_cols"), F.col("n")
    if bias_correction:
        phi2 = F.greatest(phi2 - F.try_divide((k - 1) * (r - 1), n - 1), F.lit(0.0))
        narrow = F.least(
            r - F.try_divide((r - 1) * (r - 1), n - 1) - 1,
            k - F.try_divide((k - 1) * (k - 1), n - 1) - 1,
        )
    else:
        narrow = F.least(r, k) - 1
    value = F.when(narrow > 0, F.sqrt(F.least(phi2 / narrow, F.lit(1.0))))
    out = shares.select("i", "j", value.alias("value")).where(F.col("value").isNotNull())
    return _mirrored(out, columns)
