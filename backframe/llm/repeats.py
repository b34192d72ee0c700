"""Spans of documents that occur elsewhere: what suffix-array and substring dedup share.

A window is so many consecutive units (bytes or words) of one document. Its anchor is the least
hash of its runs of ``gram`` units; equal windows have equal anchors, wherever they stand, and
neighbouring windows mostly share one, so they are dealt as stretches of windows with one anchor.

1. Documents are cut into blocks of bounded size, which are written once.
2. Each block sends its distinct anchors, truncated, to buckets by hash; a bucket answers, with a
   bit for each, which occur again. Only stretches under these can hold repeated windows; the
   truncation can but add some.
3. Each block sends the stretches in question, as text, to buckets by anchor. Equal ones of a
   block are sent once, with the least document. There the operator's own method compares them
   exactly. The answers name runs of repeated windows.
4. Each block removes what the windows cover.

Blocks meet their answers by a join on the block. A bucket gets a stretch at most once from each
block, however many documents have it. Stretches under an anchor that many blocks have stop over
at salted buckets, one for each group of blocks, where equal ones are reduced to the least
document's; what is left goes on to the anchor's bucket.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.llm.common import python_ready
from backframe.session import stored

#: Bytes of text in a block, and of text per bucket.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
NO_ID = -(1 << 63)
#: An anchor in more blocks than this is hot; about as many blocks share a salted bucket.
HOT_BLOCKS = 64
#: Bytes of an anchor that are sent; its low bytes tell the bucket.
SENT = 5
ONE = np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class ByteUnits:
    """The units of a block of texts are their bytes."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.data = b"".join(texts)

    def grams(self, gram: int) -> np.ndarray:
        n = len(self.data) - gram + 1
        padded = self.data + bytes(8)
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, 0, (1,))
        out = np.zeros(n, np.uint64)
        for at in range(0, gram, 8):
            out = mixed(out ^ eight[at : at + n])
        return out

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data = self.data
        return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class WordUnits:
    """The units are words between ASCII white space; a slice has them joined by one space."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in split], np.int64)
        self.words = [w for own in split for w in own]
        self.data = b" ".join(self.words)
        self.begins = np.concatenate([[0], np.cumsum([len(w) + 1 for w in self.words], dtype=np.int64)])

    def grams(self, gram: int) -> np.ndarray:
        own = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        n = len(own) - gram + 1
        out = np.zeros(n, np.uint64)
        for at in range(gram):
            out = mixed(out ^ own[at : at + n])
        return out

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data = self.data
        a, b = self.begins[starts].tolist(), (self.begins[ends] - 1).tolist()
        return [data[i:j] for i, j in zip(a, b, strict=True)]


@dataclass(frozen=True)
class Kind:
    """How windows are cut. ``inside``: an earlier start in the same document counts as well."""

    units: type
    window: int
    gram: int
    inside: bool

    def windows(self, text: bytes) -> int:
        """Windows of a slice."""
        return (text.count(b" ") + 1 if self.units is WordUnits else len(text)) - self.window + 1


@dataclass
class Stretches:
    """Stretches of windows with one anchor, in order: where, how many windows, whose.

    ``looped`` marks those that may hold a window twice.
    """

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    row: np.ndarray
    looped: np.ndarray


def stretches(units: ByteUnits | WordUnits, kind: Kind) -> Stretches:
    sizes = units.sizes
    total = int(sizes.sum())
    if total < kind.window:
        none = np.zeros(0, np.int64)
        return Stretches(none, none, none.astype(np.uint64), none, none.astype(bool))
    grams, width = units.grams(kind.gram), kind.window - kind.gram + 1
    anchor = sliding_least(grams, width)
    n = len(anchor)
    row = np.repeat(np.arange(len(sizes)), sizes)[:n]
    last = (np.cumsum(sizes) - kind.window)[row]  # last start of a window in the row
    valid = np.arange(n) <= last
    fresh = np.ones(n, bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(fresh & valid)
    edges = np.flatnonzero(fresh)
    following = np.append(edges, n)[np.searchsorted(edges, start) + 1]
    end = np.minimum(following, last[start] + 1)
    count = end - start
    looped = np.zeros(len(start), bool)
    if kind.inside:
        # Two equal windows of a stretch put a gram twice at their distance; a longer stretch has
        # its anchor at two places in any case.
        twice = np.zeros(len(grams) + 1, np.int64)
        for apart in range(1, width):
            twice[1 : len(grams) + 1 - apart] |= grams[apart:] == grams[:-apart]
        twice = np.cumsum(twice)
        looped = (twice[start + count + width - 1] > twice[start]) | (count > width)
    return Stretches(start, count, anchor[start], row[start], looped)


def sent_anchors(s: Stretches, ids: np.ndarray, kind: Kind, buckets: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, truncated anchors in order, whether each repeats in the block) per bucket."""
    bucket = ((s.anchor & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int64)
    short = s.anchor >> np.uint64(64 - 8 * SENT)
    order = np.lexsort((ids[s.row], short, bucket))
    bucket, short, doc = bucket[order], short[order], ids[s.row][order]
    if not len(order):
        return []
    new = np.ones(len(order), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (short[1:] != short[:-1])
    again = np.zeros(len(order), bool)
    again[1:] = ~new[1:] & ((doc[1:] != doc[:-1]) | kind.inside)
    first = np.flatnonzero(new)
    flags = np.logical_or.reduceat(again, first)
    flags |= np.logical_or.reduceat(s.looped[order], first)
    bucket, short = bucket[first], short[first]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    parts = zip(np.split(bucket, cuts), np.split(short, cuts), np.split(flags, cuts), strict=True)
    return [(int(b[0]), k, f) for b, k, f in parts]


def pack_block(ids: list[int], texts: list[bytes]) -> bytes:
    head = np.array([len(ids)], np.int64).tobytes() + np.array(ids, np.int64).tobytes()
    sizes = np.array([len(t) for t in texts], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + sizes + b"".join(texts))


def open_block(payload: bytes) -> tuple[np.ndarray, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ids, sizes = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n)
    ends = (np.cumsum(sizes) + 8 + 16 * n).tolist()
    return ids, [raw[a:b] for a, b in zip([8 + 16 * n, *ends[:-1]], ends, strict=True)] if n else []


def binary_batch(rows: list[tuple], *kinds: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    names = [f"c{i}" for i in range(len(kinds))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


EXCHANGED = "c0 long, c1 long, c2 binary"
KINDS = (pa.int64(), pa.int64(), pa.binary())


def make_blocks(block_bytes: int) -> Callable:
    """(block, bytes, payload) rows from (id, text) rows in the order that they come."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def close() -> pa.RecordBatch:
            return binary_batch([((part << 32) | number, size, pack_block(ids, texts))], *KINDS)

        for batch in batches:
            for i in range(batch.num_rows):
                name, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or ""
                raw = text.encode("utf-8", "surrogatepass")
                if ids and (size + len(raw) > block_bytes or len(ids) >= 1 << 16):
                    yield close()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(NO_ID if name is None else name)
                texts.append(raw)
                size += len(raw)
        if ids:
            yield close()

    return make


def send_anchors(kind: Kind, buckets: int) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, payload in rows_of(batches):
            ids, texts = open_block(payload)
            found = sent_anchors(stretches(kind.units(texts), kind), ids, kind, buckets)
            rows = []
            for bucket, short, flags in found:
                # High bytes first, byte by byte: sorted values have long runs of them.
                planes = short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, SENT - 1 :: -1].T
                rows.append((bucket, block, np.packbits(flags).tobytes() + planes.tobytes()))
            yield binary_batch(rows, *KINDS)

    return send


def count_of(size: int) -> int:
    """Anchors in a payload of one bit and ``SENT`` bytes for each."""
    n = size * 8 // (8 * SENT + 1)
    while -(-n // 8) + SENT * n > size:
        n -= 1
    return n


def answer_anchors(hot: int) -> Callable:
    """(block, bucket, bits and places) for (bucket, block, anchors): which occur twice, which are hot."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = defaultdict(list)
        for bucket, block, payload in rows_of(batches):
            by_bucket[bucket].append((block, payload))
        for bucket in sorted(by_bucket):
            rows, keys, flags = by_bucket[bucket], [], []
            for _, payload in rows:
                n = count_of(len(payload))
                flags.append(np.unpackbits(np.frombuffer(payload, np.uint8, -(-n // 8)), count=n).astype(bool))
                planes = np.frombuffer(payload, np.uint8, SENT * n, -(-n // 8)).reshape(SENT, n)
                full = np.zeros((n, 8), np.uint8)
                full[:, :SENT] = planes[::-1].T
                keys.append(full.view("<u8").ravel())
            key, flag = np.concatenate(keys), np.concatenate(flags)
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            same = np.zeros(len(key) + 1, bool)
            same[1:-1] = ordered[1:] == ordered[:-1]
            first = np.flatnonzero(~same[:-1])
            repeated = np.logical_or.reduceat((same[:-1] | same[1:]) | flag[order], first)
            twice, many = np.empty(len(key), bool), np.empty(len(key), bool)
            sizes = np.diff(np.append(first, len(key)))
            twice[order] = np.repeat(repeated, sizes)
            many[order] = np.repeat(sizes > hot, sizes)
            cuts = np.cumsum([len(k) for k in keys])[:-1]
            parts = zip(rows, np.split(twice, cuts), np.split(many, cuts), strict=True)
            yield binary_batch(
                [
                    (block, bucket, np.packbits(a).tobytes() + np.flatnonzero(h).astype(np.uint32).tobytes())
                    for (block, _), a, h in parts
                ],
                *KINDS,
            )
            by_bucket[bucket] = []

    return answer


def pack_texts(start: np.ndarray, row: np.ndarray, doc: np.ndarray, texts: list[bytes]) -> bytes:
    parts = [np.array([len(texts)], np.int64), start.astype(np.uint32), row.astype(np.uint32), doc.astype(np.int64)]
    sizes = np.array([len(t) for t in texts], np.uint32)
    raw = b"".join([*(p.tobytes() for p in parts), sizes.tobytes(), *texts])
    return zstandard.ZstdCompressor(level=1).compress(raw)


def open_texts(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    start, row = np.frombuffer(raw, np.uint32, n, 8), np.frombuffer(raw, np.uint32, n, 8 + 4 * n)
    doc, sizes = np.frombuffer(raw, np.int64, n, 8 + 8 * n), np.frombuffer(raw, np.uint32, n, 8 + 16 * n)
    ends = (np.cumsum(sizes, dtype=np.int64) + 8 + 20 * n).tolist()
    return start, row, doc, [raw[a:b] for a, b in zip([8 + 20 * n, *ends[:-1]], ends, strict=True)]


def runs_bytes(start: np.ndarray, count: np.ndarray) -> bytes:
    """Steps between the starts, and the counts, byte by byte, as their high bytes are mostly zero."""
    order = np.argsort(start, kind="stable")
    both = np.stack([np.diff(start[order].astype(np.int64), prepend=0), count[order]]).astype("<u4")
    planes = both.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def open_runs(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8).reshape(2, 4, -1)
    steps, count = planes.transpose(0, 2, 1).copy().view("<u4")[..., 0].astype(np.int64)
    return np.cumsum(steps), count


OWN = -1


def bucket_of(anchor: np.ndarray, wide: int) -> np.ndarray:
    return (mixed(anchor) % np.uint64(wide)).astype(np.int64)


def salt_of(block: int, groups: int) -> int:
    """Group of the block, from 1 on; bucket b of group g is numbered g * wide + b."""
    return 1 + int(mixed(np.array([block], np.uint64))[0] % np.uint64(groups))


def send_stretches(kind: Kind, buckets: int, wide: int, groups: int) -> Callable:
    """Stretches in question to their buckets; what the block alone tells goes back to itself."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, payload, answers in rows_of(batches):
            ids, texts = open_block(payload)
            units = kind.units(texts)
            s = stretches(units, kind)
            bits = {a["c1"]: a["c2"] for a in answers or ()}
            asked, many = [], []
            for bucket, short, _ in sent_anchors(s, ids, kind, buckets):
                head = -(-len(short) // 8)
                yes = np.unpackbits(np.frombuffer(bits[bucket], np.uint8, head), count=len(short)).astype(bool)
                asked.append(short[yes])
                hot = short[np.frombuffer(bits[bucket], np.uint32, -1, head)]
                many.append((hot << np.uint64(24)) | np.uint64(bucket))
            wanted = np.unique(np.concatenate(asked)) if asked else np.zeros(0, np.uint64)
            if not len(wanted):
                continue
            short = s.anchor >> np.uint64(64 - 8 * SENT)
            at = np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)
            keep = np.flatnonzero(wanted[at] == short)
            start, count, row = s.start[keep], s.count[keep], s.row[keep]
            doc = ids[row]
            pieces = units.slices(start, start + count + kind.window - 1)
            same = pa.array(pieces, pa.binary()).dictionary_encode().indices.to_numpy()
            order = np.lexsort((start, row, doc, same))
            first = np.ones(len(order), bool)
            first[1:] = same[order][1:] != same[order][:-1]
            least = doc[order][first][np.cumsum(first) - 1]
            repeat = doc[order] > least
            if kind.inside:
                repeat[1:] |= ~first[1:] & (row[order][1:] == row[order][:-1])
            own = order[repeat]
            rows = [(OWN, block, runs_bytes(start[own], count[own]))] if len(own) else []
            rest = order[~repeat]
            to = bucket_of(s.anchor[keep], wide)
            # All blocks must agree on what is hot, so it hangs on what they sent of the anchor.
            told = (short[keep] << np.uint64(24)) | ((s.anchor[keep] & np.uint64(0xFFFFFF)) % np.uint64(buckets))
            to[np.isin(told, np.concatenate(many))] += salt_of(block, groups) * wide
            rest = rest[np.argsort(to[rest], kind="stable")]
            for part in np.split(rest, np.flatnonzero(np.diff(to[rest])) + 1):
                if len(part):
                    own_texts = [pieces[i] for i in part]
                    rows.append((int(to[part[0]]), block, pack_texts(start[part], row[part], doc[part], own_texts)))
            yield binary_batch(rows, *KINDS)

    return send


def reduced(opened: list[tuple], bucket: int, kind: Kind) -> list[tuple]:
    """Of equal stretches those of the least document, to go on to the bucket.

    All windows of the others repeat, which is the answer to their blocks.
    """
    least: dict[bytes, int] = {}
    for _, _, _, doc, texts in opened:
        for own, text in zip(doc.tolist(), texts, strict=True):
            least[text] = min(own, least.get(text, own))
    rows = []
    for block, start, row, doc, texts in opened:
        repeat = doc > np.array([least[t] for t in texts])
        gone, rest = np.flatnonzero(repeat), np.flatnonzero(~repeat)
        if len(gone):
            count = np.array([kind.windows(texts[i]) for i in gone])
            rows.append((OWN, block, runs_bytes(start[gone], count)))
        if len(rest):
            rows.append((bucket, block, pack_texts(start[rest], row[rest], doc[rest], [texts[i] for i in rest])))
    return rows


#: Gets stretches as (texts, documents, rows as (block, row), starts) and tells for each window of
#: each, in order, whether it repeats.
Resolver = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]]


def runs_found(opened: list[tuple], resolve: Resolver) -> list[tuple]:
    """Runs of repeated windows, for each block, from the stretches of a bucket."""
    blocks = np.concatenate([np.full(len(o[1]), o[0]) for o in opened])
    start, row, doc = (np.concatenate([o[k] for o in opened]) for k in (1, 2, 3))
    texts = [t for o in opened for t in o[4]]
    repeats = resolve(texts, doc, np.stack([blocks, row.astype(np.int64)], axis=1), start)
    # A gap behind each stretch keeps its runs to itself.
    flat = np.concatenate([x for r in repeats for x in (r, [False])]).astype(np.int8)
    base = np.concatenate([[0], np.cumsum([len(r) + 1 for r in repeats])])
    edge = np.diff(flat, prepend=0)
    begin, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    which = np.searchsorted(base, begin, side="right") - 1
    first = start[which].astype(np.int64) + begin - base[which]
    owner = blocks[which]
    order = np.argsort(owner, kind="stable")
    owner, first, count = owner[order], first[order], (ends - begin)[order]
    parts = np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1)
    return [(OWN, int(owner[p[0]]), runs_bytes(first[p], count[p])) for p in parts if len(p)]


def answer_stretches(kind: Kind, resolve: Resolver, wide: int) -> Callable:
    """Answers of plain buckets, and what salted ones send on; answers pass as they are."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = defaultdict(list)
        for batch in batches:
            done = pc.equal(batch.column(0), OWN)
            yield batch.filter(done)
            for bucket, block, payload in rows_of([batch.filter(pc.invert(done))]):
                by_bucket[bucket].append((block, payload))
        for bucket in sorted(by_bucket):
            opened = [(block, *open_texts(payload)) for block, payload in by_bucket.pop(bucket)]
            plain = bucket < wide
            yield binary_batch(runs_found(opened, resolve) if plain else reduced(opened, bucket % wide, kind), *KINDS)

    return answer


def removed_spans(sizes: np.ndarray, answers: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """Maximal removed runs (start, length) of each row, in its own units."""
    total = int(sizes.sum())
    edge = np.zeros(total + 1, np.int32)
    for payload in answers:
        start, count = open_runs(payload)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + count + window - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    out, end = [], 0
    for size in sizes.tolist():
        own = np.diff(gone[end : end + size].astype(np.int8), prepend=0, append=0)
        a, b = np.flatnonzero(own == 1).tolist(), np.flatnonzero(own == -1).tolist()
        out.append([(i, j - i) for i, j in zip(a, b, strict=True)])
        end += size
    return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
RESULT = "key long, n_units long, spans array<struct<start: long, length: long>>, kept binary"


def apply_answers(kind: Kind, joined: bytes) -> Callable:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, payload, answers in rows_of(batches):
            ids, texts = open_block(payload)
            units = kind.units(texts)
            spans = removed_spans(units.sizes, [a["c2"] for a in answers or ()], kind.window)
            kept = []
            for text, own in zip(texts, spans, strict=True):
                parts = text.split() if kind.units is WordUnits else text
                cuts = [0, *(x for start, length in own for x in (start, start + length)), len(parts)]
                left = [parts[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
                kept.append(joined.join([w for some in left for w in some] if kind.units is WordUnits else left))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if i == NO_ID else i for i in ids.tolist()], pa.int64()),
                    pa.array(units.sizes.tolist(), pa.int64()),
                    pa.array([[{"start": a, "length": b} for a, b in own] for own in spans], SPANS),
                    pa.array(kept, pa.binary()),
                ],
                names=["key", "n_units", "spans", "kept"],
            )

    return apply


def remove_repeats(docs: DataFrame, kind: Kind, resolve: Resolver, key: str, text: str) -> DataFrame:
    """(key, n_units, spans, kept) of every document.

    ``spans`` are the maximal removed runs, ``kept`` the rest, words joined by one space. A null
    text is empty; a null key counts as less than any other; rows of one key do not count as
    before one another. Other columns are left out. An empty table gives no rows. Anchors in more
    than ``HOT_BLOCKS`` blocks go by salted buckets.
    """
    spark = docs.sparkSession
    python_ready(spark)
    own = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"))
    made = own.mapInArrow(make_blocks(BLOCK_BYTES), EXCHANGED).toDF("block", "size", "payload")
    blocks = stored(made, "blocks")
    size, number = blocks.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, size // BUCKET_BYTES)
    buckets = 2 * parts
    dealt = blocks.select("block", "payload")
    asked = dealt.mapInArrow(send_anchors(kind, buckets), EXCHANGED).repartition(parts, "c0")
    told = asked.mapInArrow(answer_anchors(HOT_BLOCKS), EXCHANGED)

    def with_answers(answers: DataFrame) -> DataFrame:
        gathered = answers.groupBy(F.col("c0").alias("block")).agg(F.collect_list(F.struct("c1", "c2")).alias("answers"))
        return dealt.join(gathered, "block", "left").select("block", "payload", "answers")

    groups = max(1, -(-number // HOT_BLOCKS))
    sent = with_answers(told).mapInArrow(send_stretches(kind, buckets, buckets, groups), EXCHANGED)
    # What goes back to its own block is spread by the block.
    place = F.when(F.col("c0") == OWN, F.col("c1")).otherwise(F.col("c0"))
    answer = answer_stretches(kind, resolve, buckets)
    # Twice, as salted buckets answer only in part: the second time, there are none.
    first = sent.repartition(parts, place).mapInArrow(answer, EXCHANGED)
    found = first.repartition(parts, place).mapInArrow(answer, EXCHANGED)
    found = found.select(F.col("c1").alias("c0"), F.col("c0").alias("c1"), "c2")
    joined = b" " if kind.units is WordUnits else b""
    return with_answers(found).mapInArrow(apply_answers(kind, joined), RESULT).withColumnRenamed("key", key)
