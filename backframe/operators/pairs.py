"""Difference from the mean response over the cells of a pair of predictors.

Two scores are in use and must not be mixed up. The *within* score of a cell is the mean
squared distance of its responses from the overall mean; the *between* score is the squared
distance of the cell's mean response. Both come from three sums per cell, which are combined
map-side, so the shuffle carries cells and not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import clean_double, pick
from backframe.operators.association import exploded_pairs
from backframe.operators.bins import Overview, bin_edges, binned, overview


def _cell_sums(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("i", "j", "a", "b").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("d").alias("s"),
        F.sum(F.col("d") * F.col("d")).alias("ss"),
    )


def _crossed(df: DataFrame, left: str, right: str) -> DataFrame:
    return (
        df.select(right, "d", F.posexplode_outer(left).alias("i", "a"))
        .where(F.col("a").isNotNull())
        .select("d", "i", "a", F.posexplode_outer(right).alias("j", "b"))
        .where(F.col("b").isNotNull())
    )


def _answered(df: DataFrame, response: str) -> DataFrame:
    """The rows with a response; a missing one or NaN takes part in no count and no sum."""
    return df.where(clean_double(response).isNotNull())


def _response(response: str) -> Column:
    return clean_double(response).alias("y")


def cells(
    df: DataFrame,
    response: str,
    continuous: Sequence[str] = (),
    categorical: Sequence[str] = (),
    bins: int = 10,
) -> DataFrame:
    """Observed cells of every pair: (x1, x2, cell1, cell2, n, mean, within, between).

    Two continuous columns or two categorical ones pair up unordered; given both kinds, each
    category pairs with each number. Continuous columns are cut into bins, and a cell then
    shows the bin's number. Rows without a response are left out, of the bins as well.
    """
    df = _answered(df, response)
    return _cells(df, response, continuous, categorical,
                  overview(df, continuous, bins, response))


def _cells(
    df: DataFrame,
    response: str,
    continuous: Sequence[str],
    categorical: Sequence[str],
    facts: Overview,
) -> DataFrame:
    labels = F.array(*[F.col(c).cast("string") for c in categorical]).alias("labels")
    # Distances from the mean are summed, not raw responses: no large numbers cancel out.
    mean = F.lit(facts.mean)
    distance = (clean_double(response) - mean).alias("d")
    rows = binned(df, continuous, facts.ranges, keep=[distance, labels])
    if continuous and categorical:
        pairs = _crossed(rows, "labels", "bins")
        left, right = categorical, continuous
    else:
        left = right = continuous or categorical
        pairs = exploded_pairs(rows, F.col("bins" if continuous else "labels"), keep=["d"])
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    return _cell_sums(pairs).select(
        pick(list(left), "i").alias("x1"),
        pick(list(right), "j").alias("x2"),
        F.col("a").alias("cell1"),
        F.col("b").alias("cell2"),
        "n",
        (mean + s / n).alias("mean"),
        (ss / n).alias("within"),
        ((s / n) * (s / n)).alias("between"),
    )


def brute_force(
    df: DataFrame,
    response: str,
    continuous: Sequence[str] = (),
    categorical: Sequence[str] = (),
    bins: int = 10,
    score: str = "within",
) -> DataFrame:
    """(x1, x2, mse, wmse) of every pair.

    ``within``: the cells' scores, plain and weighted by their share of all rows, averaged
    over the observed cells. ``between``: the sum of the scores divided by the number of
    observed cells, and their mean weighted by the cells' sizes.
    """
    df = _answered(df, response)
    facts = overview(df, continuous, bins, response)
    table = _cells(df, response, continuous, categorical, facts)
    if score == "within":
        return table.groupBy("x1", "x2").agg(
            F.avg("within").alias("mse"),
            F.avg(F.col("within") * F.col("n") / F.lit(facts.rows)).alias("wmse"),
        )
    if score == "between":
        return table.groupBy("x1", "x2").agg(
            F.avg("between").alias("mse"),
            (F.sum(F.col("between") * F.col("n")) / F.sum("n")).alias("wmse"),
        )
    raise ValueError(f"unknown score: {score}")


def binned_response(
    df: DataFrame, response: str, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """Every bin of every column, empty ones included: (name, bin, middle, n, mean, overall)."""
    df = _answered(df, response)
    facts = overview(df, columns, bins, response)
    filled = (
        binned(df, columns, facts.ranges, keep=[_response(response)])
        .select("y", F.posexplode_outer("bins").alias("i", "bin"))
        .where(F.col("bin").isNotNull())
        .groupBy(pick(list(columns), "i").alias("name"), "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"))
    )
    return (
        bin_edges(df, columns, facts.ranges)
        .join(filled, ["name", "bin"], "left")
        .select(
            "name", "bin", "lower", "upper", "middle",
            F.coalesce("n", F.lit(0)).alias("n"), "mean", F.lit(facts.mean).alias("overall"),
        )
    )


def mean_of_response(
    df: DataFrame, response: str, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """(name, mse, wmse): squared distance of bin means from the overall mean.

    Empty bins add nothing to the sum but count in the divisor of ``mse``.
    """
    distance = F.col("mean") - F.col("overall")
    d = distance * distance
    return (
        binned_response(df, response, columns, bins)
        .groupBy("name")
        .agg(
            (F.coalesce(F.sum(d), F.lit(0.0)) / F.lit(float(bins))).alias("mse"),
            F.coalesce(F.try_divide(F.sum(d * F.col("n")), F.sum("n")), F.lit(0.0)).alias("wmse"),
        )
    )

