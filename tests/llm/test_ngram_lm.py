"""The n-gram model against a plain one, and its probabilities against their sum."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import backframe.llm.ngram_lm as lm
from backframe.llm.common import table
from backframe.llm.hash_store import look_up, packed, unpacked
from tests.llm.cases import clashing, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), None]


def plain_held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.pairs, self.count = Counter(), Counter()
        for text in texts:
            own = plain_tokens(text)
            self.count.update(own)
            self.pairs.update(zip(["start", *[w and (w,) for w in own]], own, strict=False))
        self.total, self.follows, self.by_context = Counter(), Counter(), defaultdict(Counter)
        for (v, w), n in self.pairs.items():
            self.total[v] += n
            self.follows[w] += 1
            self.by_context[v][min(n, 3)] += 1
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.d, self.e = self.off(self.pairs.values()), self.off(self.follows.values())

    @staticmethod
    def off(values):
        n = Counter(values)
        if all(n[k] for k in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            own = [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
            if all(0 < d <= k for k, d in enumerate(own, 1)):
                return [0.0, *own]
        return [0.0, 0.5, 1.0, 1.5]

    def one(self, w):
        if not self.pairs:
            return 1 / (self.v + 1)
        saved = sum(self.e[min(k, 3)] for k in self.follows.values()) / len(self.pairs)
        k = self.follows[w]
        return (k - self.e[min(k, 3)]) / len(self.pairs) + saved / (self.v + 1)

    def p(self, v, w):
        if not self.total[v]:
            return self.one(w)
        saved = sum(self.d[k] * n for k, n in self.by_context[v].items()) / self.total[v]
        c = self.pairs[v, w]
        return (c - self.d[min(c, 3)]) / self.total[v] + saved * self.one(w)

    def told(self, text):
        own = plain_tokens(text)
        base = sum(math.log10((self.count[w] + 1) / (self.n + self.v + 1)) for w in own)
        score = sum(math.log10(self.p(v, w)) for v, w in zip(["start", *[w and (w,) for w in own]], own, strict=False))
        return len(own), sum(self.count[w] > 0 for w in own), self.n, base, score


@pytest.mark.parametrize(("bytes_", "kept"), [(12 << 20, 1 << 22), (9000, 50)])
def test_against_a_plain_model(spark, sf_dir, monkeypatch, bytes_, kept):
    monkeypatch.setattr(lm, "SHARD_BYTES", bytes_)
    monkeypatch.setattr(lm, "KEPT_PAIRS", kept)
    monkeypatch.setattr(lm, "LOT_CHARS", 40 * kept)
    frames = [clashing(documents(spark)).withColumnRenamed("quality", "LM")]
    if kept > 1000:
        frames.append(table(spark, sf_dir, "documents"))
    for docs in frames:
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        model = Plain([t for k, t in rows if not plain_held_out(k)])
        want = sorted(((k, plain_held_out(k), *model.told(t)) for k, t in rows), key=repr)
        made = lm.score_documents(docs).select("doc_id", "lm.*").collect()
        got = sorted((tuple(r) for r in made), key=lambda r: repr((r[0], r[1], r[2], r[3], r[4])))
        want.sort(key=lambda r: repr((r[0], r[1], r[2], r[3], r[4])))
        assert [r[:5] for r in got] == [r[:5] for r in want]
        for a, b in zip(got, want, strict=True):
            assert a[5:] == pytest.approx(b[5:], rel=1e-9)
        assert any(r[1] for r in want)


def test_no_training_texts_and_no_documents(spark):
    docs = documents(spark)
    made = lm.scored(docs, lm.train(docs.limit(0))).select("lm.*").collect()
    assert all(r["score"] == r["base_score"] == 0 and r["n_known"] == 0 for r in made)
    assert lm.score_documents(docs.limit(0)).count() == 0


def test_probabilities_add_up_to_one(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(60)
    model = lm.train(docs)
    tokens = lm.tokens_of([r["text"] for r in docs.collect()])
    names = np.sort(tokens.with_start())
    _, facts = look_up(f"{model.folder}/tokens", model.shards, names, lm.COLUMNS)
    real = facts["count"] > 0
    one = lm.token_probability(model.sums, facts["follows"][real])
    unknown = lm.token_probability(model.sums, np.array([0]))
    assert one.sum() + unknown[0] == pytest.approx(1)
    for at in [*range(0, len(names), 997), *np.flatnonzero(~real)]:
        keys = lm.pair_keys(np.full(real.sum(), names[at]), names[real])
        order = np.argsort(keys)
        found = look_up(f"{model.folder}/pairs", model.shards, keys[order], ["count"])[1]["count"]
        count = np.empty_like(found)
        count[order] = found
        context = {c: np.full(real.sum(), x[at]) for c, x in facts.items()}
        rest = lm.pair_probability(model.sums, np.array([0]), {c: x[[at]] for c, x in facts.items()}, unknown)
        assert lm.pair_probability(model.sums, count, context, one).sum() + rest[0] == pytest.approx(1)


def test_better_than_counts_plus_one_on_held_out_texts(spark, sf_dir):
    made = lm.score_documents(table(spark, sf_dir, "documents")).where("lm.held_out")
    row = made.selectExpr("sum(lm.score) AS own", "sum(lm.base_score) AS base").first()
    assert 0 > row["own"] > row["base"]
    assert lm.perplexity(made).first()["perplexity"] < 10 ** (-row["base"] / made.selectExpr("sum(lm.n_tokens)").first()[0])


def test_packed_columns_come_back():
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, 1 << b, 1000, dtype=np.uint64) for b in (1, 9, 31, 63)] + [np.array([], np.uint64)]
    for a, b in zip(columns, unpacked(packed(*columns)), strict=True):
        assert (a == b).all()
