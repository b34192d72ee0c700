"""Feature summaries and the rules that drop features.

Everything here works on tables of one row per feature or feature pair, whose size depends on
the number of columns and not on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.operators.association import pearson
from backframe.operators.models import forest_importance
from backframe.operators.pairs import mean_of_response
from backframe.operators.regression import logit_univariate
from backframe.session import stored


def feature_summary(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    trees: int = 50,
    seed: int = 1,
    bins: int = 10,
) -> DataFrame:
    """(name, mse, wmse, z_value, p_value, importance), one row per feature.

    The columns are written once, as each statistic goes over them several times.
    """
    df = stored(df.select(response, *columns), "summary-rows")
    difference = mean_of_response(df, response, columns, bins)
    statistics = logit_univariate(df, columns, response).select("name", "z_value", "p_value")
    importance = forest_importance(df, columns, response, trees, seed, is_stored=True)
    return difference.join(statistics, "name").join(importance, "name")


def printed_statistics(summary: DataFrame) -> DataFrame:
    """The statistics as a report prints them: z to six places, p in scientific notation."""
    return summary.withColumns(
        {
            "z_value": F.round("z_value", 6),
            "p_value": F.when(
                F.col("p_value").isNotNull(), F.format_string("%.6e", F.col("p_value"))
            ),
        }
    )


def prune_correlated(
    df: DataFrame,
    columns: Sequence[str],
    importance: DataFrame,
    limit: float = 0.9,
    score: str = "importance",
) -> DataFrame:
    """(name, kept, because_of): of two features correlated above ``limit`` the lesser goes.

    Features are taken in descending importance, ties by name; each is kept unless it is too
    closely correlated, in absolute value, with one kept before it.
    """
    weights = {r["name"]: r[score] for r in importance.select("name", score).collect()}
    close = {
        (r["x1"], r["x2"])
        for r in pearson(df, columns).where(F.abs("value") > limit).collect()
    }
    ordered = sorted(columns, key=lambda c: (-(weights.get(c) or 0.0), c))
    kept: list[str] = []
    rows = []
    for c in ordered:
        rival = next((k for k in kept if (c, k) in close), None)
        if rival is None:
            kept.append(c)
        rows.append((c, rival is None, rival))
    return df.sparkSession.createDataFrame(rows, "name string, kept boolean, because_of string")


def prune_weak(
    summary: DataFrame, significance: float = 0.05, least_importance: float | None = None
) -> DataFrame:
    """The summary without features that are both insignificant and unimportant.

    Unimportant means below ``least_importance``, the mean importance unless given. A feature
    without statistics counts as insignificant.
    """
    if least_importance is None:
        floor = summary.agg(F.avg("importance").alias("m")).scalar()
    else:
        floor = F.lit(float(least_importance))
    weak = (F.coalesce(F.col("p_value") > significance, F.lit(True))) & (
        F.col("importance") < floor
    )
    return summary.where(~weak)
