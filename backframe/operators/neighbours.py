"""Exact k-nearest-neighbour classification.

Reference points (pivots) cut the space into cells. From every cell's radius and its k
training points closest to the pivot follows, by the triangle inequality, a distance within
which each query of the cell surely has k neighbours; training points that cannot lie within
it are never sent to the cell. What is left is compared in blocks of bounded size: a large
cell is spread over many (query block, training block) tasks, and each task returns the k best
per query only. The driver sees pivots, radii and counts: numbers per cell, not per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backframe.session import ship_package

_SLACK = 1e-9
#: Rows that a task sends on at once, when it sends a row many times.
SENT_ROWS = 8192


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``, in bounded memory."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for start in range(0, len(a), step):
        part = a[start : start + step]
        out[start : start + step] = np.sqrt(((part[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _nearest(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``b`` of the k rows nearest to each row of ``a``, ties by place, and their distances.

    Squared distances from one matrix product in single precision rule out all rows but those that its
    rounding leaves open; these are compared exactly. Rows that it cannot tell apart are all compared.
    """
    width, all_of_b = min(k, len(b)), len(b)
    places, reach = np.empty((len(a), width), np.int64), np.empty((len(a), width))
    middle = b.mean(axis=0)
    with np.errstate(all="ignore"):
        b32 = (b - middle).astype(np.float32)
        norm = (b32 * b32).sum(axis=1)
    step = max(1, 4_000_000 // max(1, all_of_b))
    for start in range(0, len(a), step):
        part = a[start : start + step]
        with np.errstate(all="ignore"):
            a32 = (part - middle).astype(np.float32)
            near = a32 @ b32.T
            near *= -2
            near += norm
            slack = 32 * (a.shape[1] + 4) * np.finfo(np.float32).eps * ((a32 * a32).sum(axis=1) + norm.max())
        row = None
        if np.isfinite(near).all() and np.isfinite(slack).all():
            # The k-th of some columns bounds the k-th of all.
            some = min(all_of_b, max(width, 512))
            bound = np.partition(near[:, :some], width - 1, axis=1)[:, width - 1]
            row, column = np.nonzero(near <= (bound + slack)[:, None])
            if len(row) > 256 * len(part):
                row = None
        if row is None:
            d = _distances(part, b)
            best = np.argsort(d, axis=1, kind="stable")[:, :width]
            places[start : start + step], reach[start : start + step] = best, np.take_along_axis(d, best, axis=1)
            continue
        d = np.concatenate([
            np.sqrt(((part[row[i : i + 65_536]] - b[column[i : i + 65_536]]) ** 2).sum(axis=1)) for i in range(0, len(row), 65_536)
        ])
        order = np.lexsort((column, d, row))
        firsts = np.searchsorted(row, np.arange(len(part)))
        best = order[firsts[:, None] + np.arange(width)]
        places[start : start + step], reach[start : start + step] = column[best], d[best]
    return places, reach


def _kept(df: DataFrame, vector: str) -> tuple[Column, str]:
    """The vector as it travels, single precision if it has no more, and its type."""
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    return F.col(vector).cast(kind).alias("vector"), kind


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float) if len(vectors) else np.empty((0, 0))


def _to_nearest_pivot(df: DataFrame, pivots: np.ndarray, schema: str) -> DataFrame:
    ship_package(df.sparkSession)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = _distances(_matrix(batch["vector"]), pivots)
                cell = d.argmin(axis=1)
                yield batch.assign(cell=cell, reach=d[np.arange(len(d)), cell])

    return df.mapInPandas(assign, schema)


def nearest_neighbours(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int = 7,
    pivots: int | None = None,
    block: int = 8192,
) -> DataFrame:
    """(query, neighbour, label, distance, rank): the k nearest training rows of each query.

    By default there are about as many pivots as blocks of queries, 512 at most. ``key``
    identifies rows in both frames and breaks ties; the smaller key is the nearer. Labels may be
    text or numbers and stay as they are.
    """
    numbers, numbers_kind = _kept(train, vector)
    known = train.select(F.col(key).cast("long").alias("id"), numbers,
                         F.col(label).alias("label"))
    kind = known.schema["label"].dataType.simpleString()
    asked_numbers, asked_kind = _kept(queries, vector)
    asked = queries.select(F.col(key).cast("long").alias("id"), asked_numbers)

    if pivots is None:
        pivots = min(512, max(1, math.ceil(asked.count() / block)))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(pivots).select("vector").collect()
    if not chosen:
        raise ValueError("no training rows")
    centres = np.array([r["vector"] for r in chosen], dtype=float)

    known_cells = _to_nearest_pivot(
        known, centres, f"id long, vector {numbers_kind}, label {kind}, cell int, reach double"
    )
    asked_cells = _to_nearest_pivot(
        asked, centres, f"id long, vector {asked_kind}, cell int, reach double"
    )
    closest = Window.partitionBy("cell").orderBy("reach")
    near = (
        known_cells.select("cell", "reach")
        .withColumn("rank", F.row_number().over(closest))
        .where(F.col("rank") <= k)
        .collect()
    )
    facts = {
        r["cell"]: (r["radius"], r["n"])
        for r in asked_cells.groupBy("cell")
        .agg(F.max("reach").alias("radius"), F.count(F.lit(1)).alias("n"))
        .collect()
    }
    near_cell = np.array([r["cell"] for r in near])
    near_reach = np.array([r["reach"] for r in near])
    between = _distances(centres, centres)
    n_cells = len(centres)
    radius = np.full(n_cells, -1.0)
    sure = np.full(n_cells, -1.0)
    for cell, (r, _) in facts.items():
        radius[cell] = r
        bounds = np.sort(r + between[cell][near_cell] + near_reach)
        sure[cell] = bounds[k - 1] if len(bounds) >= k else math.inf
    limits = np.where(radius >= 0, (radius + sure) * (1 + _SLACK) + _SLACK, -1.0)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            row, cell = np.nonzero(_distances(_matrix(batch["vector"]), centres) <= limits)
            for a in range(0, len(row), SENT_ROWS):
                out = batch.iloc[row[a : a + SENT_ROWS]].reset_index(drop=True)
                yield out.assign(cell=cell[a : a + SENT_ROWS])

    candidates = known.mapInPandas(spread, f"id long, vector {numbers_kind}, label {kind}, cell int")
    sizes = {r["cell"]: r["n"] for r in candidates.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    q_blocks = [max(1, math.ceil(facts.get(c, (0, 0))[1] / block)) for c in range(n_cells)]
    t_blocks = [max(1, math.ceil(sizes.get(c, 0) / block)) for c in range(n_cells)]

    def count_for(blocks: list[int]):
        return F.get(F.array(*[F.lit(b) for b in blocks]), F.col("cell"))

    def own(blocks: list[int]):
        return F.pmod(F.xxhash64("id"), count_for(blocks)).cast("int")

    def every(blocks: list[int]):
        return F.explode(F.sequence(F.lit(0), count_for(blocks) - 1))

    left = asked_cells.select(
        "id", "vector", "cell", own(q_blocks).alias("q"), every(t_blocks).alias("t")
    )
    right = candidates.select(
        "id", "vector", "label", "cell", own(t_blocks).alias("t"), every(q_blocks).alias("q")
    )

    def compare(asked_part: pd.DataFrame, known_part: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "neighbour", "label", "distance"]
        if not len(asked_part) or not len(known_part):
            return pd.DataFrame({c: [] for c in columns})
        part = known_part.sort_values("id", kind="stable")
        best, d = _nearest(_matrix(asked_part["vector"]), _matrix(part["vector"]), k)
        width = best.shape[1]
        return pd.DataFrame(
            {
                "query": np.repeat(asked_part["id"].to_numpy(), width),
                "neighbour": part["id"].to_numpy()[best].ravel(),
                "label": part["label"].to_numpy()[best].ravel(),
                "distance": d.ravel(),
            }
        )

    compared = (
        left.groupBy("cell", "q", "t")
        .cogroup(right.groupBy("cell", "q", "t"))
        .applyInPandas(compare, f"query long, neighbour long, label {kind}, distance double")
    )
    order = Window.partitionBy("query").orderBy("distance", "neighbour")
    return compared.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_classify(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int = 7,
    **options: int | None,
) -> DataFrame:
    """(key, prediction): the most frequent label of the k nearest; ties go to the smallest."""
    votes = (
        nearest_neighbours(train, queries, key, vector, label, k, **options)
        .groupBy("query", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    winner = F.min(F.struct((-F.col("n")).alias("n"), F.col("label").alias("label")))
    return votes.groupBy(F.col("query").alias(key)).agg(winner["label"].alias("prediction"))
