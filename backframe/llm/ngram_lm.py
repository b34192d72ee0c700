"""Language-model scores: an interpolated modified Kneser-Ney model of word pairs.

Tokens are words in lower case (A-Z only) and one end per text; the first token of a text follows a
start that is never predicted. With c the count of a pair and C of its context among training texts,

    p(w | v) = (c - D(c)) / C + g(v) p(w),    p(w) = (k - E(k)) / K + g / (V + 1)

k is the number of contexts w follows, K their sum, V the number of distinct tokens, to which one
unknown token is added. D and E are the discounts of one, two and more, from counts of counts; g
hands on what they save, so the probabilities of all tokens and the unknown one add up to 1.

Tasks count the pairs of their texts, so a frequent pair is sent once per task, to the task that
owns its range of hashes. That one writes the pairs' counts as sorted hash arrays and hands on its
sums per token to the owners of the tokens, which write theirs. Workers map the arrays and look up
the distinct tokens and pairs of a batch. The driver sees eleven sums. Hashes have 64 bits: tokens
or pairs that share one would be counted together.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.llm.common import fresh_name, let_go, python_ready, without
from backframe.llm.hash_store import look_up, narrow, packed, shard_of, unpacked, write_shard
from backframe.session import scratch_path

#: A-Z to lower case, all other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: No word has a space in it.
END, START = b" end", b" start"
#: Bytes of training text whose pairs one shard holds, and pairs that a task keeps before it sends them.
SHARD_BYTES = 24 << 20
KEPT_PAIRS = 1 << 22
#: Characters of text that are split into words at once.
LOT_CHARS = 4_000_000
#: Discounts of one, two and more where counts of counts are too few to tell.
USUAL = (0.5, 1.0, 1.5)
COLUMNS = ["count", "follows", "total", "once", "twice", "often"]


class Sums(NamedTuple):
    """Tokens, distinct ones, distinct pairs, pairs by count 1 to 4, tokens by contexts 1 to 4."""

    tokens: int = 0
    distinct: int = 0
    pairs: int = 0
    pair_counts: tuple[int, ...] = (0, 0, 0, 0)
    follow_counts: tuple[int, ...] = (0, 0, 0, 0)


class Model(NamedTuple):
    """Where the arrays lie, and the sums."""

    folder: str
    shards: int
    sums: Sums


class Tokens(NamedTuple):
    """A batch of texts: hashes of its distinct tokens, each token's place among them, ends of texts."""

    hashes: np.ndarray
    at: np.ndarray
    ends: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Context and token of each pair as places; the start is the place behind all others."""
        before = np.empty_like(self.at)
        before[1:] = self.at[:-1]
        before[0] = before[self.ends[:-1]] = len(self.hashes)
        return before, self.at

    def with_start(self) -> np.ndarray:
        return np.append(self.hashes, np.uint64(xxhash.xxh64_intdigest(START)))


def tokens_of(texts: list[str | None]) -> Tokens:
    """At least one text; null is empty."""
    words: list[bytes] = []
    ends = []
    for text in texts:
        words += (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
        words.append(END)
        ends.append(len(words))
    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    hashes = [xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()]
    return Tokens(np.array(hashes, np.uint64), coded.indices.to_numpy().astype(np.int64), np.array(ends))


def lots(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in lists of about ``LOT_CHARS`` characters, at least one text in each."""
    lot: list[str | None] = []
    size = 0
    for text in texts:
        lot.append(text)
        size += len(text or "")
        if size > LOT_CHARS:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A hash for each pair of hashes."""
    x = (before ^ before >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + after * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, where each stands first, and its counts added up."""
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.array([], int)
    sums = np.add.reduceat(counts[order], starts) if len(own) else counts
    return own[starts], order[starts], sums


Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]


def batch_pairs(texts: list[str | None]) -> Pairs:
    """(hash of context, hash of token, count) of the distinct pairs of the texts."""
    own = tokens_of(texts)
    before, after = own.pairs()
    names = own.with_start()
    both, n = np.unique(before * len(names) + after, return_counts=True)
    return names[both // len(names)], names[both % len(names)], n.astype(np.uint64)


def merged(parts: list[Pairs]) -> Pairs:
    before, after, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, first, n = summed(pair_keys(before, after), n)
    return before[first], after[first], n


def sent(pairs: Pairs, shards: int) -> pa.RecordBatch:
    """A row (shard, blob) for each shard that owns some of the pairs; names are sent once in each."""
    before, after, n = pairs
    shard = shard_of(pair_keys(before, after), shards)
    order = np.lexsort((before, shard))
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    rows: dict[str, list] = {"shard": [], "blob": []}
    for k in np.flatnonzero(np.diff(edges)):
        own = order[edges[k] : edges[k + 1]]
        contexts, runs = np.unique(before[own], return_counts=True)
        words, places = np.unique(after[own], return_inverse=True)
        rows["shard"].append(int(k))
        rows["blob"].append(
            packed(np.diff(contexts, prepend=np.uint64(0)), runs, np.diff(words, prepend=np.uint64(0)), places, n[own])
        )
    return pa.RecordBatch.from_pydict(rows, pa.schema([("shard", pa.int32()), ("blob", pa.binary())]))


def received(blob: bytes) -> Pairs:
    contexts, runs, words, places, n = unpacked(blob)
    return np.repeat(np.cumsum(contexts), runs.astype(np.int64)), np.cumsum(words)[places.astype(np.int64)], n


def token_sums(before: np.ndarray, after: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Hashes of the tokens in the pairs, and what these add to each of ``COLUMNS``."""
    names, place = np.unique(np.concatenate([before, after]), return_inverse=True)
    v, w = place[: len(before)], place[len(before) :]
    add = lambda at, x: np.bincount(at, x, len(names)).astype(np.uint64)
    one = np.ones(len(n))
    return [names, add(w, n), add(w, one), add(v, n), add(v, n == 1), add(v, n == 2), add(v, n > 2)]


def counts_of(values: np.ndarray) -> list[int]:
    return [int((values == k).sum()) for k in range(1, 5)]


def train(texts: DataFrame, text: str = "text") -> Model:
    """Count the texts of a column and write the model's arrays to the shared folder."""
    spark = texts.sparkSession
    python_ready(spark)
    folder = scratch_path(spark, "ngrams")
    own = texts.select(F.col(f"`{text}`").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[Pairs] = []
        for batch in batches:
            for some in lots(batch.column(0).to_pylist()):
                kept.append(batch_pairs(some))
                if sum(len(n) for _, _, n in kept) > KEPT_PAIRS:
                    kept = [merged(kept)]
                    if len(kept[0][2]) > KEPT_PAIRS // 2:
                        yield sent(kept.pop(), shards)
        if kept:
            yield sent(merged(kept), shards)
        let_go()

    def own_pairs(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        before, after, n = merged([received(b.as_py()) for b in table.column("blob")])
        keys = pair_keys(before, after)
        write_shard(f"{folder}/pairs", shard, {"keys": keys, "count": narrow(n)})
        columns = token_sums(before, after, n)
        owner = shard_of(columns[0], shards)
        edges = np.searchsorted(owner, np.arange(shards + 1))
        rows = [
            {"shard": int(k), "blob": packed(np.diff(own[0], prepend=np.uint64(0)), *own[1:]), "sums": None}
            for k in np.flatnonzero(np.diff(edges))
            for own in [[c[edges[k] : edges[k + 1]] for c in columns]]
        ]
        rows.append({"shard": shard, "blob": None, "sums": [len(n), *counts_of(n)]})
        return pa.Table.from_pylist(rows, schema)

    def own_tokens(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [unpacked(b) for b in table.column("blob").to_pylist() if b is not None]
        sums = np.array([s for s in table.column("sums").to_pylist() if s is not None], np.int64).reshape(-1, 5).sum(0)
        told = [0] * 6
        if parts:
            columns = [np.concatenate(x) for x in zip(*([np.cumsum(p[0]), *p[1:]] for p in parts), strict=True)]
            order = np.argsort(columns[0], kind="stable")
            keys = columns[0][order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            added = [np.add.reduceat(c[order], starts) for c in columns[1:]]
            arrays = {"keys": keys[starts]} | {c: narrow(x) for c, x in zip(COLUMNS, added, strict=True)}
            write_shard(f"{folder}/tokens", shard, arrays)
            told = [int(added[0].sum()), int((added[0] > 0).sum()), *counts_of(added[1])]
        return pa.Table.from_pylist([{"sums": [*told, *sums.tolist()]}], pa.schema([("sums", pa.list_(pa.int64()))]))

    schema = pa.schema([("shard", pa.int32()), ("blob", pa.binary()), ("sums", pa.list_(pa.int64()))])
    pairs = own.mapInArrow(count, "shard int, blob binary")
    tokens = pairs.groupBy("shard").applyInArrow(own_pairs, "shard int, blob binary, sums array<long>")
    told = tokens.groupBy("shard").applyInArrow(own_tokens, "sums array<long>")
    row = told.agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(11)]).first()
    s = [x or 0 for x in row]
    return Model(folder, shards, Sums(s[0], s[1], s[6], tuple(s[7:11]), tuple(s[2:6])))


def discounts(counts: tuple[int, ...]) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more."""
    if min(counts) > 0:
        y = counts[0] / (counts[0] + 2 * counts[1])
        own = [k - (k + 1) * y * counts[k] / counts[k - 1] for k in (1, 2, 3)]
        if all(0 < d <= k for k, d in enumerate(own, 1)):
            return np.array([0.0, *own])
    return np.array([0.0, *USUAL])


def token_probability(sums: Sums, follows: np.ndarray) -> np.ndarray:
    """p(w) from the number of contexts that w follows."""
    if not sums.pairs:
        return np.full(len(follows), 1.0 / (sums.distinct + 1))
    off = discounts(sums.follow_counts)
    one, two = sums.follow_counts[:2]
    saved = (off[1] * one + off[2] * two + off[3] * (sums.distinct - one - two)) / sums.pairs
    return (follows - off[np.minimum(follows, 3)]) / sums.pairs + saved / (sums.distinct + 1)


def pair_probability(sums: Sums, count: np.ndarray, context: dict[str, np.ndarray], p: np.ndarray) -> np.ndarray:
    """p(w | v) from the pair's count, the sums of its context and p(w)."""
    off = discounts(sums.pair_counts)
    total = np.maximum(context["total"], 1)
    saved = (off[1] * context["once"] + off[2] * context["twice"] + off[3] * context["often"]) / total
    return np.where(context["total"] > 0, (count - off[np.minimum(count, 3)]) / total + saved * p, p)


def score_batch(model: Model, texts: list[str | None]) -> pd.DataFrame:
    own = tokens_of(texts)
    names = own.with_start()
    order = np.argsort(names)
    _, told = look_up(f"{model.folder}/tokens", model.shards, names[order], COLUMNS)
    facts = {c: np.empty_like(x) for c, x in told.items()}
    for c, x in told.items():
        facts[c][order] = x
    before, after = own.pairs()
    both, place = np.unique(before * len(names) + after, return_inverse=True)
    v, w = both // len(names), both % len(names)
    keys = pair_keys(names[v], names[w])
    order = np.argsort(keys)
    _, told = look_up(f"{model.folder}/pairs", model.shards, keys[order], ["count"])
    count = np.empty(len(keys), np.int64)
    count[order] = told["count"]
    p = pair_probability(
        model.sums, count, {c: x[v] for c, x in facts.items()}, token_probability(model.sums, facts["follows"])[w]
    )
    plain = np.log10((facts["count"] + 1) / (model.sums.tokens + model.sums.distinct + 1))
    starts = np.concatenate([[0], own.ends[:-1]])
    add = lambda x: np.add.reduceat(x, starts)
    return pd.DataFrame(
        {
            "n_tokens": np.diff(own.ends, prepend=0),
            "n_known": add((facts["count"] > 0)[own.at].astype(np.int64)),
            "base_score": add(plain[own.at]),
            "score": add(np.log10(p)[place]),
        }
    )


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "lm") -> DataFrame:
    """The documents with a struct (n_tokens, n_known, base_score, score) under ``name``.

    ``score`` is the model's log10 probability of the text, ``base_score`` that of counts plus one.
    """
    python_ready(docs.sparkSession)

    @F.pandas_udf("n_tokens long, n_known long, base_score double, score double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            told = [score_batch(model, some) for some in lots([t if isinstance(t, str) else None for t in texts])]
            yield pd.concat(told) if told else pd.DataFrame(columns=["n_tokens", "n_known", "base_score", "score"])
        let_go()

    return without(docs, [name]).withColumn(name, scores(F.col(f"`{text}`")))


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether the checksum of a key's decimal form falls to the part; a null key never does."""
    told = F.pmod(F.crc32(F.col(f"`{key}`").cast("string")), F.lit(parts)) == part
    return F.coalesce(told, F.lit(False))


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 7, part: int = 2
) -> DataFrame:
    """The documents with a struct ``lm``: held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all documents that are not held out and scores them all. A null text is
    empty and has one token, its end; a null key is not held out. Repeated rows each count. Without
    training texts every token has probability 1, as the unknown one. A column ``lm`` of the input is
    replaced, others stay.
    """
    out = held_out(key, parts, part)
    model = train(docs.where(~out), text)
    inner = fresh_name(docs, "scores")
    return without(scored(docs, model, text, inner), ["lm"]).withColumn(
        "lm",
        F.struct(
            out.alias("held_out"),
            F.col(inner)["n_tokens"].alias("n_tokens"),
            F.col(inner)["n_known"].alias("n_known"),
            F.lit(model.sums.tokens).cast("long").alias("train_tokens"),
            F.col(inner)["base_score"].alias("base_score"),
            F.col(inner)["score"].alias("score"),
        ),
    ).drop(inner)


def perplexity(scores: DataFrame) -> DataFrame:
    """(held_out, documents, tokens, perplexity) of documents with a struct ``lm``."""
    return scores.groupBy(F.col("lm.held_out").alias("held_out")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("lm.n_tokens").alias("tokens"),
        F.pow(F.lit(10.0), -F.sum("lm.score") / F.sum("lm.n_tokens")).alias("perplexity"),
    )


