"""Periodic runs of words, found by catchers on power-of-two blocks.

A stretch in which words q apart are identical, at least 2 q long, holds a square: a block of words
followed by itself. The first half of a square of half-length q in [2 s - 1, 4 s - 2] holds a whole
aligned block of s words, so each completed block of s words has a catcher that waits for its
block to come again 2 s - 1 to 4 s - 2 words later. With each appended word all catchers of a size
make one comparison; a catch is extended on both sides, word blocks first and then words, into the
run that its squares merge into. Sizes double until the longest text has no room for a square.

Catchers compare hashes of 64 bits; a run is checked word by word before it is told.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backframe.llm.common import fresh_name, let, let_go, python_ready, settled, without, words_of

#: Least length of a run in words.
LEAST = 12
#: Words that are searched side by side.
LOT_WORDS = 1 << 18

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
        ("collapsed", pa.string()),
    ]
)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash for each pair of hashes, in which the order matters."""
    x = (a ^ a >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) + (b ^ b >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def catches(names: np.ndarray, size: int, blocks: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) where a block of the size comes again at a distance of its catcher.

    ``names[i]`` stands for the words from i on, ``ends`` holds for each block where its text ends.
    """
    least, most = 2 * size - 1, 4 * size - 2
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(blocks) > 2 * size:  # an appended word for all catchers at a time
        for q in range(least, most + 1):
            open_ = blocks[blocks + (q + size) <= ends]
            hit = open_[names[open_] == names[open_ + q]]
            if len(hit):
                found.append((hit, np.full(len(hit), q)))
    else:  # all words that a catcher waits for at a time
        for b, end in zip(blocks.tolist(), ends.tolist(), strict=True):
            hit = np.flatnonzero(names[b + least : min(b + most, end - size) + 1] == names[b])
            if len(hit):
                found.append((np.full(len(hit), b), hit + least))
    if not found:
        return np.array([], np.int64), np.array([], np.int64)
    return np.concatenate([b for b, _ in found]), np.concatenate([q for _, q in found])


def reach(names: np.ndarray, size: int, at: np.ndarray, q: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How far from ``at`` on the words equal those ``q`` further, in steps of ``size``."""
    at = at.copy()
    on = np.arange(len(at))
    while len(on):
        on = on[at[on] + q[on] + size <= ends[on]]
        on = on[names[at[on]] == names[at[on] + q[on]]]
        at[on] += size
    return at


def reach_back(names: np.ndarray, size: int, at: np.ndarray, q: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How far back from ``at`` the words equal those ``q`` further, in steps of ``size``."""
    at = at.copy()
    on = np.arange(len(at))
    while len(on):
        on = on[at[on] - size >= starts[on]]
        on = on[names[at[on] - size] == names[at[on] - size + q[on]]]
        at[on] -= size
    return at


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of the maximal runs in texts laid end to end, by start, then period.

    ``words`` are numbers that stand for the words, ``ends`` the places where the texts end.
    """
    sizes = np.diff(ends, prepend=0)
    end_of, start_of = np.repeat(ends, sizes), np.repeat(ends - sizes, sizes)
    plain = words.astype(np.uint64)
    names, size = mixed(plain, plain), 1
    #: The run known so far that reaches furthest from a word on, and its period.
    known_end, known_period = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    found: dict[tuple[int, int], int] = {}
    longest = int(sizes.max(initial=0))
    while 2 * (2 * size - 1) <= longest and least <= longest:
        blocks = np.arange(0, len(names), size)
        blocks = blocks[end_of[blocks] - blocks >= 3 * size - 1]
        b, q = catches(names, size, blocks, end_of[blocks])
        # Inside a known run, a multiple of its period gives that run again.
        fresh = (b + q + size > known_end[b]) | (q % known_period[b] != 0)
        b, q = b[fresh], q[fresh]
        order = np.lexsort((b, q))
        b, q = b[order], q[order]
        if len(b):  # neighbouring blocks caught at one distance lie in one run
            first = np.concatenate([[True], (q[1:] != q[:-1]) | (b[1:] != b[:-1] + size)])
            b, q = b[first], q[first]
        right = reach(plain, 1, reach(names, size, b + size, q, end_of[b]), q, end_of[b])
        left = reach_back(plain, 1, reach_back(names, size, b, q, start_of[b]), q, start_of[b])
        enough = np.flatnonzero(right + q - left >= np.maximum(2 * q, least))
        for k in enough:
            lo, hi, period = int(left[k]), int(right[k] + q[k]), int(q[k])
            if not np.array_equal(plain[lo : hi - period], plain[lo + period : hi]):  # two hashes fell together
                one = slice(k, k + 1)
                lo = int(reach_back(plain, 1, b[one], q[one], start_of[b[one]])[0])
                hi = int(reach(plain, 1, b[one], q[one], end_of[b[one]])[0]) + period
                if hi - lo < max(2 * period, least):
                    continue
            if found.get((lo, hi), period) < period:
                continue
            found[lo, hi] = period
            own = known_end[lo:hi] < hi
            known_end[lo:hi][own] = hi
            known_period[lo:hi][own] = period
        names, size = mixed(names[:-size], names[size:]), 2 * size
    return np.array(sorted((lo, hi, p) for (lo, hi), p in found.items()), np.int64).reshape(-1, 3)


def told_lot(texts: list[list[bytes]], least: int) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """(runs, words that are kept) of each text, a list of words."""
    ends = np.cumsum([len(t) for t in texts])
    words = [w for t in texts for w in t]
    codes = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = find_runs(codes, ends, least)
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    of: dict[int, list[tuple[int, int, int]]] = {}
    for text, (lo, hi, period) in zip(owner.tolist(), runs.tolist(), strict=True):
        start = lo - int(ends[text]) + len(texts[text])
        of.setdefault(text, []).append((start, hi - lo, period))
    out = []
    for k, own in enumerate(texts):
        mine = sorted(of.get(k, ()), key=lambda r: (r[0], r[2]))
        if mine:
            gone = np.zeros(len(own) + 1, np.int64)
            for start, length, period in mine:
                gone[start + period] += 1
                gone[start + length] -= 1
            own = [w for w, g in zip(own, np.cumsum(gone).tolist(), strict=False) if not g]
        out.append((mine, b" ".join(own)))
    return out


def told_batch(texts: list[str | None], least: int) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    lot: list[list[bytes]] = []
    size = 0
    for text in texts:
        own = (text or "").encode("utf-8", "surrogatepass").split()
        if lot and size + len(own) > LOT_WORDS:
            yield from zip((len(t) for t in lot), *zip(*told_lot(lot, least), strict=True), strict=True)
            lot, size = [], 0
        lot.append(own)
        size += len(own)
    if lot:
        yield from zip((len(t) for t in lot), *zip(*told_lot(lot, least), strict=True), strict=True)


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """The documents with a struct ``periodic``: n_words, runs, collapsed.

    ``runs`` are the maximal stretches of at least ``least`` words and two periods, each with its
    smallest period, by start, then period; ``collapsed`` is the text without the words that stand
    in a run behind its first period, words joined by one space. A null, empty or blank text has no
    words and no runs. Rows are judged one by one, whatever their keys; a column ``periodic`` of the
    input is replaced, others stay. A text is searched in one task, in memory in proportion to it.
    """
    python_ready(docs.sparkSession)
    own = without(docs, ["periodic"])
    kind = T.StructType(
        [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    )
    schema = T.StructType([*own.schema.fields, T.StructField("periodic", kind)])
    place = [c.lower() for c in own.columns].index(text.lower())

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {
                    "n_words": n,
                    "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs],
                    "collapsed": kept.decode("utf-8", "surrogatepass"),
                }
                for n, runs, kept in told_batch(batch.column(place).to_pylist(), least)
            ]
            columns = [*batch.columns, pa.array(rows, ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "periodic"])
        let_go()

    return own.mapInArrow(told, schema)


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, about a tenth of which end in words of their own that repeat.

    With h the checksum of the key's decimal form and g = floor(h / 10), a text of n words is
    changed if h is divisible by 10: each word from place a = g % n on becomes the one at
    a + (i - a) % p, with p = 1 + floor((n - a) / (3 + g % 8)). A null key changes nothing.
    """
    told, own = fresh_name(docs, "planted"), F.col(f"`{text}`")
    h = F.crc32(F.col(f"`{key}`").cast("string"))
    words = F.when(F.pmod(h, F.lit(10)) == 0, words_of(own))
    settle = settled(docs, told, words.alias("words"), F.floor(h / 10).cast("long").alias("g"))
    n, g = F.size(F.col(told)["words"]).cast("long"), F.col(told)["g"]

    def repeated(words: Column) -> Column:
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        source = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i)
        return F.transform(words, lambda _, i: F.get(words, source(i).cast("int")))

    planted = F.when(n > 0, F.array_join(let(F.col(told)["words"], repeated), " ")).otherwise(own)
    return settle.withColumn(text, planted).select(docs.columns)
