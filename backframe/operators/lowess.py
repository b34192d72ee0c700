"""Locally weighted linear trends of a response, whole and at any size.

A fit at x0 weighs the points within its radius h by the tricube (1 - d^3)^3, d = |x - x0| / h, times
their trust. On either side of x0 that weight is a polynomial of degree 9 in x, so the weighted
sums a line needs follow from the sums of powers, or moments, of the points there. Distinct values
lie in chunks, cut by approximate quantiles and at wide gaps. A window covers whole chunks, of
which centred and scaled moments are known, and parts of chunks at its ends and around x0, whose
moments are running sums inside the chunk, taken from the side that lies in the window. Nothing is
ever subtracted that a point far away could dominate.

Windows move to the right with x0, so the chunks that hold the ends of a chunk's windows are few, and
they are known from the chunks' ends and counts alone. Each chunk is fitted by one task from its own
values and those of these chunks; the driver keeps some thirty numbers per chunk of ``CHUNK`` values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.functions.expressions import clean_double, pick
from backframe.operators.ranks import values_at_ranks
from backframe.session import ship_package, small, stored

#: Distinct values of a chunk.
CHUNK = 8192
#: Chunks that a window covers at least, if there are as many values.
CHUNKS_IN_WINDOW = 8
#: Part of a chunk's width from which on a gap divides it, and how many gaps do.
WIDE_GAP = 0.25
GAPS = 3
POWERS = 12


class Chunks(NamedTuple):
    """One column's chunks: ends, rows in them, rows before them, and the rows of a window."""

    lo: np.ndarray
    hi: np.ndarray
    n: np.ndarray
    before: np.ndarray
    window: int

    @property
    def rows(self) -> int:
        return int(self.n.sum())

    def holding(self, rank: np.ndarray | int) -> np.ndarray:
        """The chunk of the row of a rank, counted from 1."""
        return np.searchsorted(self.before + self.n, rank, side="left")

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Middle and half width, 0 for a chunk of one value."""
        half = self.hi / 2 - self.lo / 2
        return self.lo + half, half


def ends_of_windows(c: Chunks) -> np.ndarray:
    """For each chunk the first and last chunk where its windows may begin, and may end.

    The k nearest rows of x0 lie between some value l and r(l), the value k rows on. The middle of
    the two grows with l; the window begins next to the last l whose middle is not beyond x0.
    """
    count = len(c.lo)
    rank = c.before + c.window
    there = rank <= c.rows
    to = np.minimum(c.holding(rank), count - 1)
    latest = np.where(there, c.lo / 2 + c.hi[to] / 2, np.inf)
    earliest = np.where(there, c.lo / 2 + c.lo[to] / 2, np.inf)
    first = np.maximum(np.searchsorted(latest, c.lo, side="right") - 1, 0)
    last = np.minimum(np.searchsorted(earliest, c.hi, side="right"), count - 1)
    end_first = np.minimum(c.holding(c.before[first] + c.window), count - 1)
    end_last = c.holding(np.minimum(c.before[last] + c.n[last] - 1 + c.window, c.rows))
    return np.stack([first, last, end_first, end_last], axis=1)


def powers(x: np.ndarray, centre: float, scale: float) -> np.ndarray:
    z = (x - centre) / (scale if scale > 0 else 1.0)
    return np.cumprod([np.ones_like(z), *[z] * (POWERS - 1)], axis=0).T


def moved(moments: np.ndarray, by: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Moments in z = by + scale * (old z), row by row.

    A round adds ``by`` times the power below to every power from its own on; after all of them the
    terms of each binomial are together.
    """
    out = np.ascontiguousarray(moments.T)
    power = np.ones(len(by))
    for q in range(1, POWERS):
        power = power * scale
        out[q] *= power
    for first in range(1, POWERS):
        for q in range(POWERS - 1, first - 1, -1):
            out[q] += by * out[q - 1]
    return out.T


def weighed(t: np.ndarray, power: int) -> np.ndarray:
    """Sum of the tricube times d to a power, from the moments of d."""
    return t[:, power] - 3 * t[:, power + 3] + 3 * t[:, power + 6] - t[:, power + 9]


class Part:
    """A chunk's running moments: ``upto[i]`` of its first i values about its lower end, ``on[i]`` of
    those from the i-th on about its upper end.

    Whatever is taken from them lies in a window together with that end, however wide the chunk is. Only
    those asked for are made: a window ends in some chunks and begins in others.
    """

    def __init__(self, x: np.ndarray, sums: tuple[np.ndarray, np.ndarray]) -> None:
        self.x, self.sums = x, sums
        self.lo, self.hi = x[0], x[-1]

    @cached_property
    def upto(self) -> tuple[np.ndarray, ...]:
        first, none = powers(self.x, self.lo, self.hi - self.lo), np.zeros((1, POWERS))
        return tuple(np.concatenate([none, np.cumsum(s[:, None] * first, axis=0)]) for s in self.sums)

    @cached_property
    def on(self) -> tuple[np.ndarray, ...]:
        last, none = powers(self.x, self.hi, self.hi - self.lo), np.zeros((1, POWERS))
        return tuple(np.concatenate([np.cumsum((s[:, None] * last)[::-1], axis=0)[::-1], none]) for s in self.sums)


def radii(c: Chunks, at: np.ndarray, left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """Distance to the last of the k nearest rows, from the values where windows begin and end."""
    begins = left["before"].to_numpy()
    lx, rx = left["x"].to_numpy(), right["x"].to_numpy()
    usable = begins + c.window <= c.rows
    lx, begins = lx[usable], begins[usable]
    reach = rx[np.searchsorted(right["before"].to_numpy() + right["n"].to_numpy(), begins + c.window, side="left")]
    low = np.searchsorted(lx / 2 + reach / 2, at, side="right") - 1
    out = np.where(low >= 0, at - lx[np.maximum(low, 0)], np.inf)
    high = np.minimum(low + 1, len(lx) - 1)
    return np.minimum(out, np.where(low + 1 < len(lx), reach[high] - at, np.inf))


class Sums:
    """Weighted sums of a side of the windows, gathered piece by piece."""

    def __init__(self, at: np.ndarray, h: np.ndarray, sign: int) -> None:
        self.at, self.h, self.sign = at, h, sign
        self.t = tuple(np.zeros((len(at), POWERS)) for _ in range(2))

    def add(self, who: np.ndarray, moments: tuple[np.ndarray, np.ndarray], centre, scale) -> None:
        h = self.h[who]
        by, width = self.sign * (centre - self.at[who]) / h, self.sign * scale / h
        for t, m in zip(self.t, moments, strict=True):
            t[who] += moved(m, by, np.broadcast_to(width, by.shape))

    def add_values(self, who: int, x: np.ndarray, sums: tuple[np.ndarray, np.ndarray]) -> None:
        z = (self.sign * (x - self.at[who]) / self.h[who])[:, None] ** np.arange(POWERS)
        for t, s in zip(self.t, sums, strict=True):
            t[who] += s @ z


def fitted(c: Chunks, own: int, values: pd.DataFrame, moments: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    """(x, fit) of the values of one chunk.

    ``values`` has (chunk, x, n, s0, s1) of the chunk and of those where its windows begin and end,
    ``moments`` those of all chunks.
    """
    values = values.sort_values(["chunk", "x"], kind="stable").reset_index(drop=True)
    chunk = values["chunk"].to_numpy()
    n = values["n"].to_numpy()
    starts = np.searchsorted(chunk, chunk, side="left")
    running = np.cumsum(n) - n
    values["before"] = c.before[chunk] + running - running[starts]
    first, last, end_first, end_last = (int(k) for k in ends_of_windows(c)[own])
    left = values[(chunk >= first) & (chunk <= last)]
    right = values[(chunk >= end_first) & (chunk <= end_last)]
    mine = values[chunk == own]
    at = mine["x"].to_numpy()
    h = radii(c, at, left, right)
    alone = ~(h > 0)
    h = np.where(alone, 1.0, h)
    centre, scale = c.centre()
    parts = {
        int(k): Part(g["x"].to_numpy(), (g["s0"].to_numpy(), g["s1"].to_numpy()))
        for k, g in values.groupby("chunk", sort=False)
    }
    me = parts[own]
    own_sums = (mine["s0"].to_numpy(), mine["s1"].to_numpy())

    def whole(side: Sums, begin: np.ndarray, end: np.ndarray) -> None:
        """Add the chunks from ``begin`` to before ``end``, put together about their middle."""
        for a, b in {(int(a), int(b)) for a, b in zip(begin, end, strict=True) if a < b}:
            who = np.flatnonzero((begin == a) & (end == b))
            middle, half = c.lo[a] / 2 + c.hi[b - 1] / 2, (c.hi[b - 1] / 2 - c.lo[a] / 2) or 1.0
            joined = [
                moved(m[a:b], (centre[a:b] - middle) / half, scale[a:b] / half).sum(axis=0, keepdims=True) for m in moments
            ]
            side.add(who, tuple(np.repeat(m, len(who), axis=0) for m in joined), middle, half)

    before = Sums(at, h, -1)
    lx, lc = left["x"].to_numpy(), left["chunk"].to_numpy()
    begin = np.searchsorted(lx, at - h, side="right")
    begin_chunk = np.where(begin < len(lx), lc[np.minimum(begin, len(lx) - 1)], last)
    inside = begin_chunk == own
    begin_place = begin - np.searchsorted(lc, begin_chunk, side="left")
    near = inside & (begin_place > 0)
    for who in np.flatnonzero(near):
        piece = slice(int(begin_place[who]), int(who) + 1)
        before.add_values(int(who), at[piece], tuple(s[piece] for s in own_sums))
    far = np.flatnonzero(~near)
    before.add(far, tuple(m[far + 1] for m in me.upto), me.lo, me.hi - me.lo)
    for k in np.unique(begin_chunk[~inside]):
        who = np.flatnonzero((begin_chunk == k) & ~inside)
        edge = parts[int(k)]
        before.add(who, tuple(m[begin_place[who]] for m in edge.on), edge.hi, edge.hi - edge.lo)
    whole(before, np.where(inside, own, begin_chunk + 1), np.full(len(at), own))

    after = Sums(at, h, 1)
    rx, rc = right["x"].to_numpy(), right["chunk"].to_numpy()
    end = np.searchsorted(rx, at + h, side="left")
    end_chunk = np.where(end > 0, rc[np.maximum(end - 1, 0)], end_first)
    end_place = end - np.searchsorted(rc, end_chunk, side="left")
    inside = end_chunk <= own
    near = inside & (end_place < len(at))
    for who in np.flatnonzero(near):
        piece = slice(int(who) + 1, max(int(end_place[who]), int(who) + 1))
        after.add_values(int(who), at[piece], tuple(s[piece] for s in own_sums))
    far = np.flatnonzero(~near)
    after.add(far, tuple(m[far + 1] for m in me.on), me.hi, me.hi - me.lo)
    for k in np.unique(end_chunk[~inside]):
        who = np.flatnonzero((end_chunk == k) & ~inside)
        edge = parts[int(k)]
        after.add(who, tuple(m[end_place[who]] for m in edge.upto), edge.lo, edge.hi - edge.lo)
    whole(after, np.full(len(at), own + 1), np.where(inside, own + 1, end_chunk))

    (w_l, y_l), (w_r, y_r) = before.t, after.t
    with np.errstate(invalid="ignore", divide="ignore"):
        total = weighed(w_l, 0) + weighed(w_r, 0)
        mean_z = (weighed(w_r, 1) - weighed(w_l, 1)) / total
        mean_y = (weighed(y_l, 0) + weighed(y_r, 0)) / total
        spread = (weighed(w_l, 2) + weighed(w_r, 2)) / total - mean_z**2
        both = (weighed(y_r, 1) - weighed(y_l, 1)) / total - mean_z * mean_y
        fit = mean_y - np.where(spread > 1e-12, both / np.where(spread > 1e-12, spread, 1.0), 0.0) * mean_z
        fit = np.where(total > 1e-12 * own_sums[0].max(initial=0), fit, np.nan)
        fit = np.where(alone, own_sums[1] / own_sums[0], fit)
    return pd.DataFrame({"x": at, "fit": fit})


def chunk_cuts(levels: DataFrame, columns: int, window_share: float, chunk: int) -> list[np.ndarray]:
    """Values behind which a chunk of each column ends."""
    counts = {r["i"]: r["count"] for r in levels.groupBy("i").count().collect()}
    wanted = {
        i: min(n, max(math.ceil(n / chunk), math.ceil(CHUNKS_IN_WINDOW / max(window_share, 1.0 / n))))
        for i, n in counts.items()
    }
    # One grid for all columns; those of fewer chunks take some of its quantiles.
    most = max(wanted.values(), default=1)
    grid = [k / most for k in range(1, most)]
    cuts = [np.array([])] * columns
    if grid:
        own = levels.groupBy("i").agg(F.percentile_approx("x", grid, 20 * most).alias("q"))
        for row in own.collect():
            q, k = np.array(row["q"]), wanted[row["i"]]
            cuts[row["i"]] = np.unique(q[[round(j * most / k) - 1 for j in range(1, k)]])
    return cuts


def with_chunk(levels: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """The levels with the number of their chunk; a value on a cut lies before it."""

    def place(batches):
        for batch in batches:
            own = np.zeros(len(batch), np.int64)
            column, x = batch["i"].to_numpy(), batch["x"].to_numpy()
            for i in np.unique(column):
                own[column == i] = np.searchsorted(cuts[i], x[column == i], side="left")
            yield batch.assign(chunk=own)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in levels.schema.fields)
    return levels.mapInPandas(place, f"{fields}, chunk long")


def gap_cuts(levels: DataFrame) -> list[tuple[int, float]]:
    """(column, value before a wide gap inside a chunk), a few per chunk at most."""

    def gaps(values: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(values["x"].to_numpy())
        gap = np.diff(x) / max(x[-1] - x[0], 1e-300)
        wide = np.flatnonzero(gap > WIDE_GAP)
        wide = wide[np.argsort(-gap[wide], kind="stable")][:GAPS]
        return pd.DataFrame({"i": np.full(len(wide), values["i"].iloc[0]), "x": x[wide]})

    return [(r["i"], r["x"]) for r in levels.select("i", "chunk", "x").groupBy("i", "chunk").applyInPandas(gaps, "i int, x double").collect()]


def lowess_trend(
    df: DataFrame,
    columns: Sequence[str],
    response: str,
    share: float = 2 / 3,
    rounds: int = 3,
    chunk: int = CHUNK,
) -> DataFrame:
    """(name, x, fit): locally weighted linear trend of the response at every value of a predictor.

    A window holds ``share`` of the rows; after each of ``rounds`` fits, rows far from the curve lose
    trust by the bisquare of their residual over six medians. Rows lacking the predictor or the
    response take no part. Where half the rows and more share one value, their windows have no
    width and the fit is their mean; where no row in reach is trusted, there is no fit.
    """
    spark = df.sparkSession
    ship_package(spark)
    values = F.array(*[clean_double(c) for c in columns])
    long = df.select(clean_double(response).alias("y"), F.posexplode(values).alias("i", "x"))
    points = stored(
        long.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("i", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("trust", F.lit(1.0)),
        "points",
    )
    levels = stored(points.groupBy("i", "x").agg(F.sum("n").alias("n")), "levels")
    cuts = chunk_cuts(levels, len(columns), share, chunk)
    for i, x in gap_cuts(with_chunk(levels, cuts)):
        cuts[i] = np.union1d(cuts[i], [x])
    points = stored(with_chunk(points, cuts), "points")
    chunks, needs = {}, []
    facts = points.groupBy("i", "chunk").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n")).toPandas()
    places = {}
    for i, own in facts.sort_values("lo").groupby("i"):
        n = own["n"].to_numpy()
        window = min(max(int(share * n.sum() + 1e-10), 2), int(n.sum()))
        c = Chunks(own["lo"].to_numpy(), own["hi"].to_numpy(), n, np.cumsum(n) - n, window)
        chunks[i], places[i] = c, own["chunk"].to_numpy()
        for k, (a, b, e, f) in enumerate(ends_of_windows(c)):
            near = {k, *range(a, b + 1), *range(e, f + 1)}
            needs += [(int(i), int(places[i][j]), int(j), int(k)) for j in sorted(near)]
    if not chunks:
        return spark.createDataFrame([], "name string, x double, fit double")
    needed = stored(spark.createDataFrame(needs, "i int, chunk long, place int, of int"), "needs")
    for turn in range(rounds + 1):
        trusted = F.col("n") * F.col("trust")
        # The points know their chunk, so that no round joins the levels again.
        sums = [F.sum("n").alias("n"), F.sum(trusted).alias("s0"), F.sum(trusted * F.col("y")).alias("s1")]
        own = stored(points.groupBy("i", "x", "chunk").agg(*sums), "level-sums")
        told = stored(_fits(own, needed, chunks, places), "fits")
        if turn == rounds:
            break
        points = _trusted(points, told)
    return told.select(pick(list(columns), "i").alias("name"), "x", F.nanvl("fit", F.lit(None).cast("double")).alias("fit"))


def _fits(levels: DataFrame, needed: DataFrame, chunks: dict[int, Chunks], places: dict[int, np.ndarray]) -> DataFrame:
    """(i, x, fit) of every value, chunk by chunk."""
    spark = levels.sparkSession
    frames = {i: (places[i], *c.centre()) for i, c in chunks.items()}
    sent = spark.sparkContext.broadcast(frames)

    def add(values: pd.DataFrame) -> pd.DataFrame:
        i, chunk = int(values["i"].iloc[0]), values["chunk"].iloc[0]
        numbers, centre, scale = sent.value[i]
        k = int(np.flatnonzero(numbers == chunk)[0])
        z = powers(values["x"].to_numpy(), centre[k], scale[k])
        moments = np.concatenate([values[s].to_numpy() @ z for s in ("s0", "s1")])
        return pd.DataFrame({"i": [i], "k": [k], "m": [moments.tolist()]})

    made = {i: np.zeros((len(c.lo), 2 * POWERS)) for i, c in chunks.items()}
    for row in levels.groupBy("i", "chunk").applyInPandas(add, "i int, k int, m array<double>").collect():
        made[row["i"]][row["k"]] = row["m"]
    known = spark.sparkContext.broadcast({i: (c, (made[i][:, :POWERS], made[i][:, POWERS:])) for i, c in chunks.items()})

    def fit(values: pd.DataFrame) -> pd.DataFrame:
        i, own = int(values["i"].iloc[0]), int(values["of"].iloc[0])
        c, moments = known.value[i]
        return fitted(c, own, values, moments).assign(i=i)

    met = levels.join(small(needed), ["i", "chunk"]).select("i", "of", F.col("place").alias("chunk"), "x", "n", "s0", "s1")
    return met.groupBy("i", "of").applyInPandas(fit, "i int, x double, fit double")


def _trusted(points: DataFrame, fits: DataFrame) -> DataFrame:
    """The points with the trust that their residuals leave them; a curve that fits keeps its own."""
    off = stored(points.join(fits, ["i", "x"]).withColumn("v", F.abs(F.col("y") - F.col("fit"))), "residuals")
    real = off.where(~F.isnan("v"))
    totals = real.groupBy("i").agg(F.sum("n").alias("m"))
    half = (F.col("m") - 1) / 2
    wanted = totals.select("i", F.explode(F.array(F.floor(half), F.ceil(half))).alias("k")).distinct()
    middle = values_at_ranks(real.select("i", "v", "n"), ["i"], wanted).groupBy("i").agg((6 * F.avg("v")).alias("scale"))
    part = F.col("v") / F.col("scale")
    trust = F.when(part < 1, F.pow(1 - part * part, F.lit(2))).otherwise(0.0)
    kept = F.when(F.col("scale") > 0, F.when(F.isnan("v"), 0.0).otherwise(trust)).otherwise(F.col("trust"))
    return stored(off.join(F.broadcast(middle), "i").select("i", "x", "y", "n", "chunk", kept.alias("trust")), "points")
