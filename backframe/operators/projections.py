"""Approximate nearest neighbours from hashed projections.

Each table hashes a vector by the cells that a few random projections of it fall into; near vectors
share many cells. A query looks in its own bucket of each table and in those beside it that it lies
closest to (multi-probe). Candidates are compared exactly, so every distance told is right; only
a neighbour may be missed. The cells are as narrow as a bounded sample, searched in itself, allows at the
wanted recall; neighbours among all rows are nearer than those within the sample, so more are found.
Where near and far hardly differ, as in unstructured vectors of many dimensions, that is a wide cell, and
the work comes near that of comparing all.

Vectors travel once per table, queries once per bucket looked into. A bucket is compared in blocks of bounded
size, so a crowded one is spread over many tasks; of equal vectors the k least keys stand for all.
Queries that found fewer than k candidates are answered by the exact operator.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backframe.operators.neighbours import SENT_ROWS, _distances, _kept, _matrix, _nearest, nearest_neighbours
from backframe.session import ship_package, stored


@dataclass(frozen=True)
class Tables:
    """``projections`` to a table, ``probes`` buckets looked into in each.

    ``sample`` rows at most, those of the least key hashes, set the cell width, so that ``found`` of
    their neighbours are met.
    """

    tables: int = 16
    projections: int = 12
    probes: int = 16
    found: float = 0.93
    sample: int = 2048
    block: int = 1024
    seed: int = 7


class _Hashes:
    """The projections of all tables, in units of a cell."""

    def __init__(self, how: Tables, dimensions: int, cell: float) -> None:
        rng = np.random.default_rng(how.seed)
        shape = (dimensions, how.tables * how.projections)
        self.how, self.directions = how, rng.normal(size=shape) / cell
        self.shift = rng.uniform(size=shape[1])
        self.mix = rng.integers(1, 1 << 62, shape[1]) | 1

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, tables, projections): the projections, whose whole parts are the cells."""
        flat = vectors @ self.directions + self.shift
        return flat.reshape(len(vectors), self.how.tables, self.how.projections)

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        """(rows, tables): a hash of the table and its cells."""
        mix = self.mix.reshape(1, self.how.tables, self.how.projections)
        with np.errstate(over="ignore"):
            return (np.floor(cells).astype(np.int64) * mix).sum(axis=2) * 31 + np.arange(self.how.tables)

    def probed(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, bucket) of the buckets that lie closest to each vector, its own first.

        Moving a projection into the next cell costs the square of its distance to the border; the
        sets of moves with the least sums are taken, out of all sets of the cheapest few.
        """
        at = self.cells(vectors)
        part = at - np.floor(at)
        moves = np.concatenate([part, 1 - part], axis=2)
        own = self.buckets(at)
        mix = self.mix.reshape(self.how.tables, self.how.projections)
        steps = np.concatenate([-mix, mix], axis=1)
        cheap = np.argsort(moves, axis=2)[:, :, : min(moves.shape[2], max(1, math.ceil(math.log2(self.how.probes)) + 2))]
        cost = np.take_along_axis(moves, cheap, axis=2) ** 2
        step = np.take_along_axis(np.broadcast_to(steps, moves.shape), cheap, axis=2)
        count = cheap.shape[2]
        sets = (np.arange(1 << count)[:, None] >> np.arange(count)) & 1
        # A projection moves one way at most.
        place = cheap % self.how.projections
        twice = np.zeros((*cost.shape[:2], len(sets)), bool)
        for i in range(count):
            for j in range(i):
                twice |= (place[:, :, i] == place[:, :, j])[:, :, None] & (sets[:, i] & sets[:, j]).astype(bool)
        total = np.where(twice, np.inf, cost @ sets.T)
        best = np.argsort(total, axis=2, kind="stable")[:, :, : self.how.probes]
        with np.errstate(over="ignore"):
            moved = own[:, :, None] + np.take_along_axis(step @ sets.T, best, axis=2) * 31
        moved = moved.reshape(len(vectors), -1)
        rows = np.repeat(np.arange(len(vectors)), moved.shape[1])
        return rows, moved.ravel()


def _hashes(known: DataFrame, k: int, how: Tables) -> _Hashes:
    """Projections in cells of the least width, in steps of a tenth, that meets enough in the sample."""
    rows = known.orderBy(F.xxhash64("id"), "id").limit(how.sample).select("vector").collect()
    if not rows:
        raise ValueError("no training rows")
    vectors = np.array([r["vector"] for r in rows], dtype=float)
    some = vectors[:256]
    d = _distances(some, vectors)
    near = np.argsort(d, axis=1, kind="stable")[:, 1 : k + 1]
    real = np.take_along_axis(d, near, axis=1).ravel()
    real = real[real > 0]
    cell = float(np.median(real)) / 2 if len(real) else 1.0
    while True:
        hashes = _Hashes(how, vectors.shape[1], cell)
        if not len(real):
            return hashes
        own = hashes.buckets(hashes.cells(vectors))
        asked, looked = hashes.probed(some)
        looked = looked.reshape(len(some), -1)
        met = [np.isin(own[near[i]], looked[i]).any(axis=1).mean() for i in range(len(some))]
        if np.mean(met) >= how.found:
            return hashes
        cell *= 1.1


def approximate_neighbours(
    train: DataFrame, queries: DataFrame, key: str, vector: str, label: str, k: int = 7, how: Tables = Tables()
) -> DataFrame:
    """(query, neighbour, label, distance, rank): k near training rows of each query, nearly always the nearest.

    Same form and ties as ``nearest_neighbours``. Every training row is indexed and every query is answered
    with k rows, if there are as many.
    """
    spark = train.sparkSession
    ship_package(spark)
    numbers, numbers_kind = _kept(train, vector)
    known = train.select(F.col(key).cast("long").alias("id"), numbers, F.col(label).alias("label"))
    asked_numbers, asked_kind = _kept(queries, vector)
    asked = queries.select(F.col(key).cast("long").alias("id"), asked_numbers)
    kind = known.schema["label"].dataType.simpleString()
    hashes = _hashes(known, k, how)
    # Of equal vectors no query needs more than the k least keys.
    alike = Window.partitionBy(F.xxhash64("vector"), "vector").orderBy("id")
    few = known.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k).drop("place")

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, SENT_ROWS // how.tables)
            for a in range(0, len(batch), step):
                part = batch.iloc[a : a + step]
                buckets = hashes.buckets(hashes.cells(_matrix(part["vector"])))
                out = part.iloc[np.repeat(np.arange(len(part)), buckets.shape[1])].reset_index(drop=True)
                yield out.assign(bucket=buckets.ravel())

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, SENT_ROWS // (how.tables * how.probes))
            for a in range(0, len(batch), step):
                part = batch.iloc[a : a + step]
                rows, buckets = hashes.probed(_matrix(part["vector"]))
                yield part.iloc[rows].reset_index(drop=True).assign(bucket=buckets)

    indexed = few.mapInPandas(index, f"id long, vector {numbers_kind}, label {kind}, bucket long")
    probed = asked.mapInPandas(probe, f"id long, vector {asked_kind}, bucket long").distinct()
    counts = lambda df, name: df.groupBy("bucket").agg(F.count(F.lit(1)).alias(name))
    # Only buckets that hold rows and are looked into matter; each is cut into blocks.
    met = stored(counts(indexed, "rows").join(counts(probed, "asked"), "bucket"), "buckets")

    def blocks(n: str) -> Column:
        return F.ceil(F.col(n) / how.block).cast("int")

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), blocks(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(n) - 1))

    left = probed.join(met, "bucket").select("id", "vector", "bucket", own("asked").alias("q"), every("rows").alias("t"))
    right = indexed.join(met, "bucket").select(
        "id", "vector", "label", "bucket", own("rows").alias("t"), every("asked").alias("q")
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

    result = f"query long, neighbour long, label {kind}, distance double"
    compared = left.groupBy("bucket", "q", "t").cogroup(right.groupBy("bucket", "q", "t")).applyInPandas(compare, result)
    order = Window.partitionBy("query").orderBy("distance", "neighbour")
    once = compared.groupBy("query", "neighbour").agg(F.first("label").alias("label"), F.min("distance").alias("distance"))
    found = stored(once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "candidates")
    enough = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("query")
    left_over = stored(queries.join(enough, F.col(key).cast("long") == F.col("query"), "left_anti"), "few-candidates")
    if left_over.isEmpty():
        return found
    exact = nearest_neighbours(train, left_over, key, vector, label, k)
    return found.join(enough, "query", "left_semi").unionByName(exact)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(n, recall): the share of the exact neighbours that were found."""
    hit = exact.join(found.select("query", "neighbour", F.lit(1).alias("hit")), ["query", "neighbour"], "left")
    return hit.agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
