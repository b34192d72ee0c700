"""Collocations: phrases of two to four words that occur often and mostly together.

Words that occur often enough in their language are numbered; the texts are written once as such
numbers. A phrase can be frequent only if the phrase without its last word and the one without its
first are, so candidates grow level by level from occurrences of frequent ones. Frequent phrases
stand in a double-array trie that is broadcast; workers advance the states of all text positions
together, one level at a time, and count what comes next: for growing, the words behind accepted
states, for the result, the accepted states themselves, by bincount. Spark adds up the shards.

A trie holds the phrases that begin with some of the words, ``TRIE_NODES`` at most as estimated from
the pairs; there are as many rounds as that takes. Texts travel once, for counting words; later only
counts do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from backframe.llm.common import let_go, python_ready
from backframe.llm.hash_store import look_up, packed, shard_of, unpacked, write_shard
from backframe.session import scratch_path, stored

LEAST = 30
LONGEST = 4
#: A shorter phrase goes if a longer one around it has this many per cent of its occurrences.
SHARE = 80
TOP = 2000
#: Phrases that one trie may hold, words of a stored block, and words whose phrases one shard adds up.
TRIE_NODES = 2_000_000
BLOCK_WORDS = 1 << 18
SHARD_WORDS = 1 << 21
#: Characters of text that are split into words at once, keys that a task keeps before it sends them.
LOT_CHARS = 2_000_000
KEPT_KEYS = 1 << 20
#: Places that are tried for the children of a state before the arrays grow.
TRIES = 4096
#: Fixed value: the seed of Spark's own XXH64.
SEED = 42
NO_LANG = "und"
#: Marks in stored blocks: the end of a piece, and a word that is not frequent.
MARK, RARE = -2, -1
#: A-Z to lower case; white space but for line ends to a space; every end of a piece to a full stop.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else 46 if 10 <= c <= 13 or c in b".,;:!?" else c for c in range(256)
)


def tokens_of(texts: list[str | None]) -> list[bytes]:
    """Words of the texts in order, a full stop between pieces and behind each text."""
    out: list[bytes] = []
    for text in texts:
        out += (text or "").encode("utf-8", "surrogatepass").translate(FOLD).replace(b".", b" . ").split()
        out.append(b".")
    return out


def coded(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """Distinct tokens, and each token's place among them."""
    own = pa.array(tokens_of(texts), pa.large_binary()).dictionary_encode()
    return own.dictionary.to_pylist(), own.indices.to_numpy().astype(np.int64)


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str | None]]]:
    """Texts of one language, of about ``LOT_CHARS`` together."""
    of: dict[str, list[str | None]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        of.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text or "")
        if sizes[lang] > LOT_CHARS:
            yield lang, of.pop(lang)
            sizes[lang] = 0
    yield from of.items()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words; ``docs`` has lang and text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in by_language(batch):
                words, places = coded(texts)
                n = np.bincount(places, minlength=len(words))
                real = [k for k, w in enumerate(words) if w != b"."]
                columns = [[lang] * len(real), [words[k] for k in real], n[real].astype(np.int64)]
                types = (pa.string(), pa.binary(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])
        let_go()

    parts = docs.mapInArrow(count, "lang string, word binary, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame, folder: str, shards: int) -> tuple[DataFrame, int]:
    """(lang, word, n, id) and how many; the ids by hash are written as sorted arrays.

    Ids count from 0, language by language, so that the words that may follow a phrase lie near
    each other, and by hash within, shard by shard, so that no task numbers them all. The driver
    sees a count per language and shard.
    """
    spark = words.sparkSession
    key = F.xxhash64("lang", "word")
    shard = F.shiftright(F.shiftrightunsigned(key, 33) * shards, 31).cast("int")
    own = stored(words.select("*", key.alias("key"), shard.alias("shard")), "words")
    sizes = sorted((r["lang"], r["shard"], r["count"]) for r in own.groupBy("lang", "shard").count().collect())
    before = np.concatenate([[0], np.cumsum([n for _, _, n in sizes], dtype=np.int64)])
    starts = [(lang, k, int(at)) for (lang, k, _), at in zip(sizes, before, strict=False)]
    offsets = spark.createDataFrame(starts, "lang string, shard int, start long")

    unsigned = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    place = F.row_number().over(Window.partitionBy("lang", "shard").orderBy(unsigned, "word")) - 1
    placed = own.select("*", place.cast("long").alias("place")).join(F.broadcast(offsets), ["lang", "shard"])
    named = stored(placed.select("lang", "word", "n", "key", "shard", (F.col("start") + F.col("place")).alias("id")), "numbered")

    def put(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        ids = table.column("id").to_numpy()[order]
        write_shard(folder, table.column("shard")[0].as_py(), {"keys": keys[order], "id": ids})
        return pa.table({"n": pa.array([len(ids)], pa.int64())})

    named.select("key", "shard", "id").groupBy("shard").applyInArrow(put, "n long").agg(F.sum("n")).first()
    return named.select("lang", "word", "n", "id"), int(before[-1])


def as_numbers(docs: DataFrame, folder: str, shards: int) -> DataFrame:
    """(ids) blocks of the texts as 32-bit numbers, words of a few thousand texts in each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            body = np.concatenate(kept).tobytes()
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["ids"])

        for batch in batches:
            for lang, texts in by_language(batch):
                words, places = coded(texts)
                seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
                keys = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)
                order = np.argsort(keys)
                found, told = look_up(folder, shards, keys[order], ["id"])
                ids = np.empty(len(words), np.int64)
                ids[order] = np.where(found, told["id"], RARE)
                ids[[k for k, w in enumerate(words) if w == b"."]] = MARK
                kept.append(ids.astype(np.int32)[places])
                if sum(map(len, kept)) > BLOCK_WORDS:
                    yield block()
        if kept:
            yield block()
        let_go()

    return docs.mapInArrow(write, "ids binary")


class Trie(NamedTuple):
    """A double array: from state s, word w leads to t = base[s] + w if check[t] is s.

    The states of single words are their numbers, 0 to ``n_words``.
    """

    base: np.ndarray
    check: np.ndarray
    n_words: int


def no_phrases(n_words: int) -> Trie:
    """Single words alone; one that no text has, if there are none."""
    states = max(n_words, 1)
    return Trie(np.zeros(states, np.int32), np.full(states, -1, np.int32), states)


def wider(trie: Trie, more: int) -> Trie:
    pad = lambda a, fill: np.concatenate([a, np.full(more, fill, a.dtype)])
    return Trie(pad(trie.base, 0), pad(trie.check, -1), trie.n_words)


def phrase_of(trie: Trie, states: np.ndarray, longest: int) -> list[np.ndarray]:
    """The words on the way to each state: rows of ``longest`` numbers, -1 before the first."""
    out = []
    for _ in range(longest):
        single = states < trie.n_words
        parents = np.where(single, -1, trie.check[states])
        words = np.where(single, states, states - trie.base[parents])
        out.append(np.where(states >= 0, words, -1))
        states = np.where(states >= 0, parents, -1)
    return out[::-1]


def room_for(words: np.ndarray, used: np.ndarray, bases: np.ndarray) -> int | None:
    """The first of the bases under which all slots of the words are free."""
    for a in range(0, len(words), 16):
        bases = bases[~used[words[a : a + 16, None] + bases].any(axis=0)]
        if not len(bases):
            return None
    return int(bases[0])


def grown(trie: Trie, parents: np.ndarray, words: np.ndarray, level: int) -> Trie:
    """The trie with a child of each parent for the word beside it.

    Parents of many children are placed first, where all of these fit; single children then take
    the slots left over, in order.
    """
    order = np.lexsort((words, parents))
    parents, words = parents[order], words[order]
    starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]])) if len(parents) else np.array([], int)
    sizes = np.diff(np.append(starts, len(parents)))
    n_words, old = trie.n_words, len(trie.check)
    trie = wider(trie, len(parents) + len(parents) // 2 + n_words + 16)
    used = trie.check >= 0
    used[:n_words] = True
    draw = np.random.default_rng(level)
    slots = np.empty(len(parents), np.int64)
    for k in np.argsort(-sizes, kind="stable"):
        if sizes[k] < 2:
            break
        own = words[starts[k] : starts[k] + sizes[k]]
        fits = room_for(own, used, draw.integers(n_words - own[0], len(used) - own[-1], TRIES))
        if fits is None:  # behind all that is there
            fits = len(used) - int(own[0])
            trie = wider(trie, int(own[-1]) + n_words)
            used = np.concatenate([used, np.zeros(len(trie.check) - len(used), bool)])
        slots[starts[k] : starts[k] + sizes[k]] = own + fits
        used[own + fits] = True
    single = starts[sizes == 1]
    slots[single] = np.flatnonzero(~used)[: len(single)]
    trie.check[slots] = parents
    trie.base[parents] = slots - words
    end = max(int(slots.max(initial=-1)) + 1, old)
    return Trie(trie.base[:end].copy(), trie.check[:end].copy(), n_words)


def advanced(trie: Trie, states: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The states behind the next words, -1 where there are none."""
    at = np.where((states >= 0) & (words >= 0), trie.base[np.maximum(states, 0)] + words, -1)
    at[at >= len(trie.check)] = -1
    ok = at >= 0
    ok[ok] = trie.check[at[ok]] == states[ok]
    return np.where(ok, at, -1)


def shifted(values: np.ndarray, by: int) -> np.ndarray:
    """The values ``by`` places on, the end of a piece behind the last."""
    return np.concatenate([values[by:], np.full(min(by, len(values)), MARK, values.dtype)])


def walk(trie: Trie, ids: np.ndarray, level: int, part: int, parts: int) -> Iterator[np.ndarray]:
    """States of all positions behind 1, 2, ... ``level`` words, of phrases that begin in the part."""
    states = np.where((ids >= 0) & (ids % parts == part), ids, -1)
    yield states
    for k in range(1, level):
        states = advanced(trie, states, shifted(ids, k))
        yield states


KEYS = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def counted_batch(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], schema=KEYS)


def together(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their counts added up."""
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.array([], int)
    return keys[starts], np.add.reduceat(n[order], starts) if len(keys) else n


def sent(keys: np.ndarray, n: np.ndarray, shards: int) -> pa.RecordBatch:
    """A row (shard, blob) for each shard that owns some of the sorted keys."""
    owner = shard_of(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), shards)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(shards + 1))
    own = [order[edges[k] : edges[k + 1]] for k in range(shards)]
    blobs = [packed(np.diff(keys[o], prepend=0).astype(np.uint64), n[o].astype(np.uint64)) for o in own if len(o)]
    places = [k for k, o in enumerate(own) if len(o)]
    return pa.RecordBatch.from_pydict({"shard": places, "blob": blobs}, pa.schema([("shard", pa.int32()), ("blob", pa.binary())]))


def added_up(parts: DataFrame, least: int) -> DataFrame:
    """(key, n) of the keys that occur often enough in all blobs of their shard together."""

    def add(table: pa.Table) -> pa.Table:
        own = [unpacked(b) for b in table.column("blob").to_pylist()]
        keys, n = together([(np.cumsum(k).astype(np.int64), c.astype(np.int64)) for k, c in own])
        often = n >= least
        return pa.Table.from_batches([counted_batch(keys[often], n[often])])

    return parts.groupBy("shard").applyInArrow(add, "key long, n long")


def extensions(blocks: DataFrame, known, level: int, part: int, parts: int, least: int, shards: int) -> DataFrame:
    """(key, n): state of a phrase of ``level - 1`` words << 32 | next word, often enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = known.value
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for ids in batch.column(0):
                own = np.frombuffer(ids.as_py(), "<i4").astype(np.int64)
                for states in walk(trie, own, level - 1, part, parts):
                    pass
                word = shifted(own, level - 1)
                safe = (states >= 0) & (word >= 0)
                if parts == 1 and level > 2:  # the trie tells of the phrase without its first word too
                    safe &= shifted(states, 1) >= 0
                kept.append(np.unique(states[safe] << 32 | word[safe], return_counts=True))
                if sum(len(k) for k, _ in kept) > KEPT_KEYS:
                    yield sent(*together(kept), shards)
                    kept.clear()
        if kept:
            yield sent(*together(kept), shards)
        let_go()

    return added_up(blocks.mapInArrow(count, "shard int, blob binary"), least)


def accepted(blocks: DataFrame, known, longest: int, part: int, parts: int, shards: int) -> DataFrame:
    """(key, n): how often each state of two and more words is reached."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = known.value
        accepting = np.flatnonzero(trie.check >= 0)
        total = np.zeros(len(accepting), np.int64)
        for batch in batches:
            for ids in batch.column(0):
                own = np.frombuffer(ids.as_py(), "<i4").astype(np.int64)
                for k, states in enumerate(walk(trie, own, longest, part, parts)):
                    if k:
                        reached = np.searchsorted(accepting, states[states >= 0])
                        total += np.bincount(reached, minlength=len(total))
        some = total > 0
        if some.any():
            yield sent(accepting[some], total[some], shards)
        let_go()

    return added_up(blocks.mapInArrow(count, "shard int, blob binary"), 1)


def pulled(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The two columns of a frame of bounded size."""
    table = frame.select("key", "n").toArrow()
    return tuple(table.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))


def frequent_phrases(blocks: DataFrame, n_words: int, least: int, longest: int, nodes: int, shards: int) -> DataFrame:
    """(ids, n) of the phrases of two and more words, by the numbers of their words."""
    spark = blocks.sparkSession
    bare = no_phrases(n_words)
    known = spark.sparkContext.broadcast(bare)
    pairs = stored(extensions(blocks, known, 2, 0, 1, least, shards), "pairs")
    known.destroy()
    parts = max(1, math.ceil(pairs.count() * (longest - 1) / nodes))
    made = None
    for part in range(parts):
        found, _ = pulled(pairs.where(F.pmod(F.shiftright("key", 32), F.lit(parts)) == part))
        trie = grown(bare, found >> 32, found & 0xFFFFFFFF, 2)
        for level in range(3, longest + 1):
            known = spark.sparkContext.broadcast(trie)
            found, _ = pulled(extensions(blocks, known, level, part, parts, least, shards))
            trie = grown(trie, found >> 32, found & 0xFFFFFFFF, level)
            known.destroy()
        known = spark.sparkContext.broadcast(trie)
        slots, n = pulled(accepted(blocks, known, longest, part, parts, shards))
        known.destroy()
        columns = {f"w{k}": pa.array(w, pa.int32()) for k, w in enumerate(phrase_of(trie, slots, longest))}
        told = spark.createDataFrame(pa.table(columns | {"n": pa.array(n, pa.int64())}))
        ids = F.filter(F.array(*columns), lambda w: w >= 0).alias("ids")
        own = stored(told.select(ids, "n"), "phrases")
        made = own if made is None else made.unionAll(own)
    return made


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    longest: int = LONGEST,
    share: int = SHARE,
    top: int | None = TOP,
    nodes: int = TRIE_NODES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language, or all.

    ``a`` counts a phrase within pieces of text, ``l`` and ``r`` the parts of its weakest cut, ``n``
    all words of the language; score is floor(2000000 a / (l + r)). A phrase goes if a longer
    candidate around it has at least ``share`` per cent of its occurrences. A null language is
    ``und``; a null or empty text has no words. Rows count as they come, repeated ones too; without
    frequent phrases the result is empty. Other columns are left out.
    """
    spark = docs.sparkSession
    python_ready(spark)
    own = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").alias("text"))
    counts = stored(word_counts(own), "word-counts")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_path(spark, "word-numbers")
    words, n_words = numbered(counts.where(F.col("n") >= least), folder, shards)
    blocks = stored(as_numbers(own, folder, shards), "blocks")
    size = counts.agg(F.sum("n")).first()[0] or 0
    phrases = frequent_phrases(blocks, n_words, least, longest, nodes, max(shards, -(-size // SHARD_WORDS)))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked(phrases, words, totals, longest, share, top)


def ranked(phrases: DataFrame, words: DataFrame, totals: DataFrame, longest: int, share: int, top: int | None) -> DataFrame:
    """Scores, covered phrases removed, the words put back, the first of each language."""
    single = words.select(F.array(F.col("id").cast("int")).alias("ids"), "n")
    known = phrases.unionAll(single)
    size = F.size("ids")
    cuts = phrases.select("ids", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "*", F.expr("slice(ids, 1, k)").alias("first"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("rest")
    )
    left = known.select(F.col("ids").alias("first"), F.col("n").alias("l"))
    right = known.select(F.col("ids").alias("rest"), F.col("n").alias("r"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    parts = cuts.join(left, "first").join(right, "rest").select(
        "ids", "a", "k", "l", "r", (F.lit(2_000_000).cast("decimal(10,0)") * exact("a")).alias("twice"),
        (exact("l") + exact("r")).alias("both"),
    ).select("ids", "a", "k", "l", "r", F.expr("twice div both").alias("score"))
    weakest = parts.groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("c")).select("ids", "c.*")
    inner = [
        F.when(size >= at + k - 1, F.when(size > k, F.expr(f"slice(ids, {at}, {k})")))
        for k in range(2, longest)
        for at in range(1, longest - k + 2)
    ]
    around = (
        phrases.select(F.explode(F.array_compact(F.array(*inner))).alias("ids"), "n")
        .groupBy("ids")
        .agg(F.max("n").alias("around"))
    )
    covered = F.coalesce(F.lit(100).cast("decimal(10,0)") * exact("around") >= F.lit(share).cast("decimal(10,0)") * exact("a"), F.lit(False))
    # Read twice; stored, it keeps the plan, which the driver holds, half as large.
    left_over = stored(weakest.join(around, "ids", "left").where(~covered), "left-over")
    spelled = (
        left_over.select("ids", F.posexplode("ids").alias("at", "id"))
        .join(words.select(F.col("id").cast("int").alias("id"), "lang", F.col("word").cast("string").alias("word")), "id")
        .groupBy("ids")
        .agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("ids", "lang", F.array_join(F.col("words.word"), " ").alias("phrase"))
    )
    own = left_over.join(spelled, "ids").select("lang", "phrase", "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # Compared as it is numbered, the limit also holds in each task before the languages meet.
    placed = own.select("*", F.row_number().over(order).alias("rank"))
    if top is not None:
        placed = placed.where(F.col("rank") <= top)
    return placed.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
