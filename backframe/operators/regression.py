"""Logistic regression of a binary response on one predictor at a time.

All predictors are fitted together: an iteration is one pass that explodes each row into
(predictor, value) inside the task and keeps five sums per predictor. Only these sums, a few
numbers per predictor, reach the driver, which takes the Newton step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import clean_double

SCHEMA = "name string, coefficient double, z_value double, p_value double, n bigint, status string"


def _newton_step(sums) -> tuple[float, float] | None:
    det = sums["w"] * sums["wzz"] - sums["wz"] ** 2
    if not det > 1e-12 * max(sums["w"] * sums["wzz"], 1e-300):
        return None
    return (
        (sums["wzz"] * sums["g"] - sums["wz"] * sums["gz"]) / det,
        (sums["w"] * sums["gz"] - sums["wz"] * sums["g"]) / det,
    )


def logit_univariate(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    max_iterations: int = 35,
    tolerance: float = 1e-10,
    cache: bool = True,
) -> DataFrame:
    """(name, coefficient, z_value, p_value, n, status) of each predictor; the response is 0/1.

    A predictor without spread, or one that separates the response or does not settle, has no finite
    estimate and gets NULL statistics; ``status`` tells ``no spread`` or ``not converged``, else
    ``converged``. ``firth_univariate`` has estimates for separated ones. Rows lacking the response or the predictor's value are left out.
    The fit takes some eight passes; ``cache=False`` reads the input anew in each, for a stored
    table whose columns would not fit the executors' memory and disks.
    """
    spark = df.sparkSession
    narrow = df.select(
        F.col(response).cast("double").alias("__y"),
        *[clean_double(c).alias(f"__x{i}") for i, c in enumerate(columns)],
    ).where(F.col("__y").isNotNull())
    if cache:
        narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        moments = narrow.agg(
            *[F.avg(f"__x{i}").alias(f"m{i}") for i in range(len(columns))],
            *[F.stddev_pop(f"__x{i}").alias(f"s{i}") for i in range(len(columns))],
        ).first()
        usable = [i for i in range(len(columns)) if (moments[f"s{i}"] or 0.0) > 0.0]
        values = F.array(
            *[
                (F.col(f"__x{i}") - F.lit(moments[f"m{i}"])) / F.lit(moments[f"s{i}"])
                for i in usable
            ]
        )
        long = narrow.select(F.col("__y").alias("y"), F.posexplode(values).alias("i", "z")).where(
            F.col("z").isNotNull()
        ) if usable else None
        a = dict.fromkeys(range(len(usable)), 0.0)
        b = dict.fromkeys(range(len(usable)), 0.0)
        open_fits = set(a)
        failed: set[int] = set()
        final: dict[int, dict] = {}
        for _ in range(max_iterations):
            if not open_fits:
                break
            wanted = sorted(open_fits)
            at = F.array(*[F.struct(F.lit(a[i]).alias("a"), F.lit(b[i]).alias("b")) for i in a])
            eta = F.get(at, F.col("i"))["a"] + F.get(at, F.col("i"))["b"] * F.col("z")
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
            w, g = F.col("p") * (1.0 - F.col("p")), F.col("y") - F.col("p")
            sums = (
                long.where(F.col("i").isin(wanted))
                .select("i", "z", "y", p.alias("p"))
                .groupBy("i")
                .agg(
                    F.count(F.lit(1)).alias("n"),
                    F.sum(w).alias("w"),
                    F.sum(w * F.col("z")).alias("wz"),
                    F.sum(w * F.col("z") * F.col("z")).alias("wzz"),
                    F.sum(g).alias("g"),
                    F.sum(g * F.col("z")).alias("gz"),
                )
                .collect()
            )
            for row in sums:
                i = row["i"]
                step = _newton_step(row)
                if step is None or abs(a[i] + step[0]) > 1e3 or abs(b[i] + step[1]) > 1e3:
                    failed.add(i)
                    open_fits.discard(i)
                    continue
                final[i] = row.asDict()
                if max(abs(step[0]), abs(step[1])) <= tolerance:
                    open_fits.discard(i)
                    continue
                a[i] += step[0]
                b[i] += step[1]
        failed |= open_fits
    finally:
        if cache:
            narrow.unpersist()
    rows = []
    for position, name in enumerate(columns):
        i = usable.index(position) if position in usable else None
        if i is None or i in failed or i not in final:
            rows.append((name, None, None, None, None, "no spread" if i is None else "not converged"))
            continue
        f = final[i]
        det = f["w"] * f["wzz"] - f["wz"] ** 2
        z_value = b[i] / math.sqrt(f["w"] / det)
        rows.append(
            (name, b[i] / moments[f"s{position}"], z_value,
             math.erfc(abs(z_value) / math.sqrt(2.0)), f["n"], "converged")
        )
    return spark.createDataFrame(rows, SCHEMA)
