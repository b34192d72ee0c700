"""Benchmark decontamination by a Wu-Manber search for word windows."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backframe.llm.common import fresh_name, let_go, python_ready
from backframe.session import stored

WINDOW = 13
#: Words of a block, on which the shift and the suffix tables are built.
BLOCK = 3
#: Bytes of benchmark text that one pass over the documents searches for. Its tables take about a
#: hundred times that in the driver and in each worker while they are built and read.
PASS_BYTES = 2 << 20

#: ASCII letters and digits and all bytes above 127 are parts of words; A-Z go to lower case.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)

Words = tuple[bytes, ...]


def fold_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


class Searcher(NamedTuple):
    """The tables for patterns of one length; block length and default shift follow from it."""

    length: int
    block: int
    shift: dict[Words, int]
    bucket: dict[Words, list[tuple[Words, tuple[int, ...]]]]


def build(patterns: dict[Words, set[int]]) -> list[Searcher]:
    """Tables per pattern length, so that a short item costs the long ones no shift."""
    by_length: dict[int, list[Words]] = defaultdict(list)
    for p in patterns:
        by_length[len(p)].append(p)
    out = []
    for length, own in sorted(by_length.items()):
        block = min(BLOCK, length)
        shift: dict[Words, int] = {}
        bucket: dict[Words, list] = defaultdict(list)
        for p in own:
            for end in range(block, length + 1):
                piece = p[end - block : end]
                shift[piece] = min(length - end, shift.get(piece, length))
            bucket[p[length - block :]].append((p, tuple(sorted(patterns[p]))))
        out.append(Searcher(length, block, shift, dict(bucket)))
    return out


def search(words: list[bytes], searcher: Searcher) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Start and items of every occurrence of a pattern."""
    length, block, shift, bucket = searcher
    far, end, n = length - block + 1, length, len(words)
    while end <= n:
        suffix = tuple(words[end - block : end])
        skip = shift.get(suffix, far)
        if skip:
            end += skip
            continue
        window = tuple(words[end - length : end])
        for pattern, items in bucket[suffix]:
            if pattern == window:
                yield end - length, items
        end += 1


def item_patterns(rows: list[tuple[str, str]]) -> tuple[dict[Words, set[int]], list[str]]:
    """Windows of the items, with the places of their ids in the list that follows."""
    patterns: dict[Words, set[int]] = defaultdict(set)
    names: dict[str, int] = {}
    for name, text in rows:
        words = fold_words(text)
        if not words:
            continue
        at = names.setdefault(name, len(names))
        for i in range(max(1, len(words) - WINDOW + 1)):
            patterns[tuple(words[i : i + WINDOW])].add(at)
    return dict(patterns), list(names)


def passes(benchmark: DataFrame, pass_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The distinct items in lists of about ``pass_bytes``; at least one list, if an empty one."""
    own = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    own = own.where("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // pass_bytes))
    for part in range(parts):
        some = own if parts == 1 else own.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        yield [(r["item"], r["text"]) for r in some.collect()]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """The documents with a struct ``hits`` (n_words, n_hit, n_items, items_sha256, contaminated).

    The tables of the benchmark are sent to the workers in passes of bounded size; each pass adds
    its hit words and items to what the documents carry along. A null text, of a document or an
    item, has no words and matches nothing; an item without id counts for none; items repeated
    under one id count once. Rows are judged one by one, whatever their id; a column ``hits`` of
    the input is replaced. An empty benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    python_ready(spark)
    docs = docs.drop("hits")
    names = [fresh_name(docs, c) for c in ("hit_mask", "hit_words", "hit_count", "hit_items")]
    mask, n_words, n_hit, items = names
    kinds = [T.BinaryType(), T.LongType(), T.LongType(), T.ArrayType(T.StringType())]
    state = docs.withColumns(
        {c: F.lit(None).cast(k) for c, k in zip(names[:3], kinds[:3], strict=True)}
        | {items: F.array().cast(kinds[3])}
    )
    carried = state.schema

    def scan(sent) -> Callable:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searchers, known = sent.value
            for batch in batches:
                rows = []
                columns = [batch.column(batch.schema.get_field_index(c)) for c in (text, mask, items)]
                for body, old, own in zip(*(c.to_pylist() for c in columns), strict=True):
                    words = fold_words(body or "")
                    hit, new = bytearray(old) if old else None, set()
                    for searcher in searchers:
                        for start, found in search(words, searcher):
                            hit = hit or bytearray(len(words))
                            hit[start : start + searcher.length] = b"\1" * searcher.length
                            new.update(found)
                    own = sorted({*own, *(known[i] for i in new)})
                    rows.append((bytes(hit) if hit else None, len(words), hit.count(1) if hit else 0, own))
                added = dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {}
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(added.get(f.name, ()), f.type) if f.name in names else batch.column(i)
                        for i, f in enumerate(batch.schema)
                    ],
                    schema=batch.schema,
                )
            let_go()

        return add

    for number, rows in enumerate(passes(benchmark, pass_bytes)):
        if number:
            state = stored(state, "decontaminate")
        patterns, known = item_patterns(rows)
        sent = spark.sparkContext.broadcast((build(patterns), known))
        state = state.mapInArrow(scan(sent), carried)
    count = F.col(n_hit)
    return state.withColumn(
        "hits",
        F.struct(
            F.col(n_words).alias("n_words"),
            count.alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
            ((count > 0) & (20 * count >= F.col(n_words))).alias("contaminated"),
        ),
    ).drop(*names)
