"""Logistic regression by Firth's penalised likelihood, one predictor at a time.

The likelihood is multiplied by the root of the information's determinant. Estimates stay finite where a
predictor separates the response, and lose most of the bias of small samples. The penalty's part
of the score, a sum of leverages times (1/2 - p), is a sum of powers of the predictor up to the third,
so a step needs one pass over the rows like a plain fit, all predictors together. The same pass
tells the penalised likelihood, by which a step that went too far is halved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import clean_double

SCHEMA = "name string, coefficient double, z_value double, p_value double, n bigint, status string"
#: Most that one step moves a parameter, in deviations of the predictor.
LONGEST_STEP = 5.0


class Sums(NamedTuple):
    """What a pass tells at one pair of parameters."""

    n: int
    likelihood: float
    w: float
    wz: float
    wzz: float
    g: float
    gz: float
    c0: float
    c1: float
    c2: float
    c3: float

    @property
    def determinant(self) -> float:
        return self.w * self.wzz - self.wz**2

    @property
    def penalised(self) -> float:
        return self.likelihood + 0.5 * math.log(self.determinant) if self.determinant > 0 else -math.inf

    def step(self) -> tuple[float, float]:
        """Fisher step of the penalised score, cut to the longest one allowed."""
        det = self.determinant
        v00, v01, v11 = self.wzz / det, -self.wz / det, self.w / det
        g = self.g + v00 * self.c0 + 2 * v01 * self.c1 + v11 * self.c2
        gz = self.gz + v00 * self.c1 + 2 * v01 * self.c2 + v11 * self.c3
        a, b = v00 * g + v01 * gz, v01 * g + v11 * gz
        cut = min(1.0, LONGEST_STEP / max(abs(a), abs(b), 1e-300))
        return a * cut, b * cut


def _pass(long: DataFrame, at: dict[int, tuple[float, float]]) -> dict[int, Sums]:
    """Sums per predictor; ``at`` has the parameters of those that are still open."""
    table = F.create_map(*[x for i, (a, b) in at.items() for x in (F.lit(i), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))])
    own = F.element_at(table, F.col("i"))
    eta = own["a"] + own["b"] * F.col("z")
    rows = long.where(F.col("i").isin(*at)).select("i", "z", "y", eta.alias("eta"))
    z, y, p = F.col("z"), F.col("y"), F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("eta")))
    rows = rows.select("i", "z", "y", "eta", p.alias("p"))
    w = F.col("p") * (1.0 - F.col("p"))
    # log(1 + exp(x)) without overflow
    soft = F.greatest(F.col("eta"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("eta")))
    half = w * (0.5 - F.col("p"))
    sums = rows.groupBy("i").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y * F.col("eta") - soft).alias("likelihood"),
        F.sum(w).alias("w"), F.sum(w * z).alias("wz"), F.sum(w * z * z).alias("wzz"),
        F.sum(y - F.col("p")).alias("g"), F.sum((y - F.col("p")) * z).alias("gz"),
        *[F.sum(half * F.pow(z, F.lit(k))).alias(f"c{k}") for k in range(4)],
    )
    return {r["i"]: Sums(*[r[c] for c in Sums._fields]) for r in sums.collect()}


def firth_univariate(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    max_iterations: int = 100,
    tolerance: float = 1e-9,
    cache: bool = True,
) -> DataFrame:
    """(name, coefficient, z_value, p_value, n, status) of each predictor; the response is 0/1.

    ``status`` is ``converged``, ``no spread`` (nothing to fit: statistics are NULL) or ``not
    converged`` (those of the last step). Rows lacking the response or the predictor are left out; the
    z-value is the coefficient over its error in the information at the estimate.
    """
    spark = df.sparkSession
    narrow = df.select(
        F.col(response).cast("double").alias("y"), *[clean_double(c).alias(f"x{i}") for i, c in enumerate(columns)]
    ).where(F.col("y").isNotNull())
    if cache:
        narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = narrow.agg(
            *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(columns))],
            *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(len(columns))],
        ).first()
        usable = [i for i in range(len(columns)) if (facts[f"s{i}"] or 0.0) > 0.0]
        fits = _fit(narrow, usable, facts, max_iterations, tolerance) if usable else {}
    finally:
        if cache:
            narrow.unpersist()
    rows = []
    for i, name in enumerate(columns):
        if i not in fits:
            rows.append((name, None, None, None, None, "no spread"))
            continue
        (_, b), sums, settled = fits[i]
        z = b / math.sqrt(sums.w / sums.determinant)
        status = "converged" if settled else "not converged"
        rows.append((name, b / facts[f"s{i}"], z, math.erfc(abs(z) / math.sqrt(2.0)), sums.n, status))
    return spark.createDataFrame(rows, SCHEMA)


def _fit(narrow: DataFrame, usable: list[int], facts, max_iterations: int, tolerance: float) -> dict[int, tuple]:
    """Parameters, sums there, and whether they settled, of each usable predictor."""
    values = F.map_from_arrays(
        F.array(*[F.lit(i) for i in usable]),
        F.array(*[(F.col(f"x{i}") - F.lit(facts[f"m{i}"])) / F.lit(facts[f"s{i}"]) for i in usable]),
    )
    long = narrow.select("y", F.explode(values).alias("i", "z")).where(F.col("z").isNotNull())
    at = dict.fromkeys(usable, (0.0, 0.0))
    here = _pass(long, at)
    step = {i: s.step() for i, s in here.items()}
    settled = dict.fromkeys(usable, False)
    for _ in range(max_iterations):
        open_ = {i: (at[i][0] + step[i][0], at[i][1] + step[i][1]) for i in usable if not settled[i]}
        if not open_:
            break
        for i, sums in _pass(long, open_).items():
            size = max(abs(x) for x in step[i])
            # Near the top the likelihood no longer tells one point from the next.
            if sums.penalised < here[i].penalised - 1e-9 * abs(here[i].penalised) and size > tolerance:
                step[i] = (step[i][0] / 2, step[i][1] / 2)
                continue
            at[i], here[i] = open_[i], sums
            step[i] = sums.step()
            settled[i] = max(abs(x) for x in step[i]) <= tolerance
    return {i: (at[i], here[i], settled[i]) for i in usable}
