"""SimHash fingerprints, linked by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backframe.llm.common import fresh_name, let_go, python_ready, whole_partition
from backframe.llm.graph import components
from backframe.session import stored

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
#: Candidate rows that one task compares.
TASK_ROWS = 1_000_000
#: A-Z to lower case, all other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle: int) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], "<u8")
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        some = hashes[i : i + (1 << 16)]
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = 2 * votes > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents with their fingerprint as a long, its bits those of the unsigned value."""
    python_ready(docs.sparkSession)

    @F.pandas_udf("long")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            prints = [fingerprint(t, shingle) if isinstance(t, str) else 0 for t in texts]
            yield pd.Series(np.array(prints, np.uint64).view(np.int64))
        let_go()

    return docs.withColumn(name, made(F.col(f"`{text}`")))


def ring(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments: one more than the distance, as even as can be."""
    parts = distance + 1
    edges = [i * BITS // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def candidate_keys(prints: DataFrame, distance: int) -> DataFrame:
    """(print, place, key) for chains of two segments at each place of the ring.

    If the differences of all segments add up to the distance at most, then from some segment on
    every chain of k consecutive ones adds up to at most k * distance / (distance + 1), rounded
    down: nothing in the first, at most one bit in the first two, and so on. So a pair within the
    distance agrees, at some place, in one segment and in the next but for a bit. The key holds
    both segments; a fingerprint stands under its own key, and under the keys that it has with one
    set bit of the second segment cleared. Of two that differ in a bit, one has it set and
    meets the other there.
    """
    segments = ring(distance)
    one = F.lit(1).cast("long")
    bit = lambda b: F.call_function("shiftleft", one, b)

    def keys_at(at: int) -> Column:
        (shift, width), (next_shift, next_width) = segments[at], segments[(at + 1) % len(segments)]
        own = F.shiftrightunsigned("print", shift).bitwiseAND((1 << width) - 1)
        following = F.shiftrightunsigned("print", next_shift).bitwiseAND((1 << next_width) - 1)
        key = F.shiftleft(own, next_width).bitwiseOR(following)
        bits = F.filter(
            F.sequence(F.lit(0), F.lit(next_width - 1)), lambda b: following.bitwiseAND(bit(b)) != 0
        )
        keys = F.concat(F.array(key), F.transform(bits, lambda b: key - bit(b)))
        return F.transform(keys, lambda k: F.struct(F.lit(at).alias("place"), k.alias("key")))

    places = [keys_at(at) for at in range(len(segments))]
    return prints.select("print", F.explode(F.concat(*places)).alias("at")).select("print", "at.*")


def chain_masks(distance: int) -> np.ndarray:
    """Row per place: masks of the chains of 2, 3, ... segments from there on."""
    segments = ring(distance)
    out = np.zeros((len(segments), distance), np.uint64)
    for at in range(len(segments)):
        mask = 0
        for k in range(distance + 1):
            shift, width = segments[(at + k) % len(segments)]
            mask |= ((1 << width) - 1) << shift
            if k:
                out[at, k - 1] = mask
    return out


def near(a: np.ndarray, b: np.ndarray, masks: list[np.uint64] | np.ndarray, distance: int) -> np.ndarray:
    """Whether pairs pass every chain, the last of which is the whole ring: the Hamming check.

    ``masks`` are the masks of one place, or a column of masks for each pair.
    """
    differ = a ^ b
    ok = np.ones(differ.shape, bool)
    for k in range(distance):
        budget = (k + 2) * distance // (distance + 1)
        ok &= np.bitwise_count(differ & masks[k]) <= budget
    return ok


def forest(prints: np.ndarray, masks: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs that connect what the near pairs of a large group connect, at most one per member.

    Each member reached is compared with those not yet reached, and takes along the ones near it;
    in a group of near copies the first few take nearly all.
    """
    out = []
    rest = np.sort(prints)
    while len(rest) > 1:
        todo, rest = [rest[:1]], rest[1:]
        while todo and len(rest):
            front = todo.pop()
            for i, one in enumerate(front):
                close = near(one, rest, masks, distance)
                if close.any():
                    taken = rest[close]
                    out.append((np.full(len(taken), one), taken))
                    rest = rest[~close]
                    todo.append(taken)
                if not len(rest):
                    break
    return out


def links(prints: DataFrame, distance: int = DISTANCE, task_rows: int = TASK_ROWS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the distance, enough to connect all such.

    ``prints`` has a column ``print`` of distinct longs.
    """
    spark = prints.sparkSession
    python_ready(spark)
    masks = chain_masks(distance)
    n = prints.count()
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, n * (distance + 1) * 8 // task_rows)

    def connect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = whole_partition(batches)
        if rows is None:
            return
        place, key = rows["place"].to_numpy(np.int64), rows["key"].to_numpy(np.int64)
        own = rows["print"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort((own, key, place))
        place, key, own = place[order], key[order], own[order]
        fresh = np.concatenate([[True], (place[1:] != place[:-1]) | (key[1:] != key[:-1])])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(own)))
        found = []
        for size in range(2, 33):  # groups of a size side by side, member i against member i + k
            first = starts[sizes == size]
            for i in range(size - 1) if len(first) else ():
                for j in range(i + 1, size):
                    a, b = own[first + i], own[first + j]
                    ok = near(a, b, masks[place[first]].T, distance)
                    found.append((a[ok], b[ok]))
        for start, size in zip(starts[sizes > 32], sizes[sizes > 32], strict=True):
            found += forest(own[start : start + size], masks[place[start]], distance)
        if found:
            a = np.concatenate([x for x, _ in found]).view(np.int64)
            b = np.concatenate([x for _, x in found]).view(np.int64)
            yield pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    dealt = candidate_keys(prints, distance).repartition(parts, "place", "key")
    return dealt.mapInPandas(connect, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """(key, fingerprint, component_id) of every document.

    Components are of the fingerprints within the distance; the component's id is the least key
    in it. A null or blank text has fingerprint zero, linked like any other; a shorter text is one
    shingle. Repeated rows are members like others; a null key never names a component that has
    another. Other columns are left out. The texts are read once, for the fingerprints, which are
    written; equal ones are one node with their least key, so copies make no pairs.
    """
    name, value = fresh_name(docs, "print"), fresh_name(docs, "value")
    own = docs.select(F.col(f"`{key}`").alias(value), F.col(f"`{text}`"))
    prints = stored(
        with_fingerprint(own, name, text, shingle).select(
            F.col(value).alias("own_key"), F.col(name).alias("print")
        ),
        "prints",
    )
    nodes = stored(prints.groupBy("print").agg(F.min("own_key").alias("least")), "nodes")
    roots = components(links(nodes.select("print"), distance))
    rooted = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("print", "component_id")
    return prints.join(named, "print").select(
        F.col("own_key").alias(key),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """Of each group of near-duplicates the row with the least key, in all its columns.

    A row without key gets one from its text, behind all others. Rows that repeat a key and a text are
    one; of rows that repeat a key with unlike texts each stands for its own group, by the hash of
    its text. The join that picks the rows has a key per row, so no group meets in a task.
    """
    row = fresh_name(docs, "row_key")
    number = fresh_name(docs, "row_number")
    digest = F.xxhash64(F.col(f"`{text}`"))
    substitute = F.lit(1 << 62) + F.pmod(digest, F.lit(1 << 61))
    own = F.struct(F.coalesce(F.col(f"`{key}`").cast("long"), substitute).alias("key"), digest.alias("digest"))
    keyed = docs.withColumn(row, own)
    first = (
        near_duplicates(keyed.select(row, f"`{text}`"), row, text, shingle, distance)
        .where(F.col(row) == F.col("component_id"))
        .select(row)
    )
    picked = keyed.join(first, row, "left_semi")
    numbered = picked.withColumn(number, F.row_number().over(Window.partitionBy(row).orderBy(row)))
    return numbered.where(F.col(number) == 1).select(docs.columns)
