"""Shortest-pack-first packing over the histogram of piece lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from backframe.llm.common import let_go, python_ready
from backframe.llm.tokens import tokenizer_path, word_encoder
from backframe.session import stored

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Texts that a worker encodes at once.
AT_ONCE = 2000
#: Pieces of one length that one task numbers.
RANK_ROWS = 500_000

Pattern = tuple[int, ...]


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Packing patterns, as lengths in order of placement, with the number of packs of each.

    As many packs as the tokens need at least are open from the start. Lengths go longest first;
    all pieces of a length are placed together, into the packs that are filled least, as long as
    the length fits there, else into new ones. Equal packs are one pattern with a count, so a
    step costs no more for many pieces than for few, and at most one pattern is split per placement.
    """
    open_packs: dict[int, list[list]] = defaultdict(list)  # by tokens filled: [pattern, count]
    fills: list[int] = []

    def put(pattern: Pattern, filled: int, count: int) -> None:
        if filled not in open_packs:
            fills.insert(bisect_left(fills, filled), filled)
        for own in open_packs[filled]:
            if own[0] == pattern:
                own[1] += count
                return
        open_packs[filled].append([pattern, count])

    tokens = sum(length * n for length, n in histogram.items())
    if tokens:
        put((), 0, -(-tokens // capacity))
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not fills or fills[0] + length > capacity:
                each = min(left, capacity // length)
                put((length,) * each, length * each, left // each)
                left %= each
                continue
            filled = fills[0]
            pattern, count = open_packs[filled].pop()
            if not open_packs[filled]:
                del open_packs[filled]
                fills.pop(0)
            taken = min(count, left)
            put((*pattern, length), filled + length, taken)
            if taken < count:
                put(pattern, filled, count - taken)
            left -= taken
    return {own: n for packs in open_packs.values() for own, n in packs if own}


def slots(patterns: dict[Pattern, int]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset) for runs of pieces.

    The pieces of one length, by rank, fill the places for that length, pattern by pattern.
    """
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, count in sorted(patterns.items(), reverse=True):
        offset = 0
        for length in pattern:
            out.append((length, used[length], used[length] + count, sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return out


def pieces(docs: DataFrame, key: str, text: str, capacity: int, path: str) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens) of every piece of at most ``capacity`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for i in range(0, len(batch), AT_ONCE):
                some = batch.slice(i, AT_ONCE)
                buffer, edges = encoder.encode(some.column(1))
                rows = []
                for name, a, b in zip(some.column(0).to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    ids = bytes(buffer[a:b]) + end
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        own = ids[4 * start : 4 * (start + capacity)]
                        rows.append((name, start, len(own) // 4, zlib.crc32(own), n))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        encoder.forget()
        let_go()

    names = ["name", "start", "length", "ids_crc32", "doc_tokens"]
    kinds = [pa.string(), *[pa.int64()] * 4]
    # The key travels as text, which keeps nulls and all digits.
    own = docs.select(F.col(f"`{key}`").cast("string").alias("name"), F.col(f"`{text}`").alias("body"))
    found = own.mapInArrow(cut, "name string, start long, length long, ids_crc32 long, doc_tokens long")
    kind = docs.schema[key].dataType
    return found.select(F.col("name").cast(kind).alias(key), "start", "length", "ids_crc32", "doc_tokens")


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    A document is its ids and the end id; what exceeds ``capacity`` is cut off in whole
    sequences. A null text is empty: a piece that holds the end id. Repeated rows are packed each
    for itself, and ties of key, start and length are ordered by their digest; rows that agree in all are
    interchangeable. Other columns are left out. An empty table gives no pieces.

    The pieces are written once. Their histogram, at most ``capacity`` rows, goes to the driver,
    which returns the places by pattern, their number bounded by the capacity alone. A piece
    finds its place by its rank among pieces of its length; ranks are counted in chunks by hash,
    so that a length that a third of the pieces have is no task's alone.
    """
    spark = docs.sparkSession
    python_ready(spark)
    cut = stored(pieces(docs, key, text, capacity, tokenizer_path(tokenizer)), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    chunks = max(1, -(-max(histogram.values(), default=0) // rank_rows), min(64, sum(histogram.values()) // 20_000))
    places = spark.createDataFrame(
        slots(shortest_pack_first(histogram, capacity)),
        "length long, first long, after long, sequence long, offset long",
    )
    chunked = cut.withColumn("chunk", F.pmod(F.xxhash64(key, "start", "ids_crc32"), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        chunked.groupBy("length", "chunk")
        .agg(F.count("*").alias("rows"))
        .select("length", "chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "chunk").orderBy(F.col(key), "start", "ids_crc32")
    ranked = (
        chunked.withColumn("number", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "chunk"])
        .withColumn("rank", F.col("base") + F.col("number"))
    )
    # Runs of places are as many as the patterns hold pieces, whatever the data: safe to send.
    of_length = places.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("first", "after", "sequence", "offset"))).alias("runs")
    )
    run = F.element_at(F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["after"])), 1)
    return (
        ranked.join(F.broadcast(of_length), "length")
        .withColumn("run", run)
        .select(
            key,
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            (F.col("run.sequence") + F.col("rank") - F.col("run.first")).alias("sequence_id"),
            F.col("run.offset").alias("offset"),
        )
    )
