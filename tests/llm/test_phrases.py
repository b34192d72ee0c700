"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import backframe.llm.phrases as phrases
from backframe.llm.common import table
from tests.llm.cases import clashing, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest=4, share=80, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    often = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = {
        (lang, p[i:j])
        for (lang, p), a in often.items()
        for i in range(len(p))
        for j in range(i + 2, len(p) + 1)
        if j - i < len(p) and 100 * a >= share * f[lang, p[i:j]]
    }
    out = []
    for lang in total:
        own = []
        for (of, p), a in often.items():
            if of == lang and (of, p) not in gone:
                cuts = [(2000000 * a // (f[of, p[:k]] + f[of, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                own.append((score, a, " ".join(p), f[of, p[:k]], f[of, p[k:]]))
        own.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, x, y, total[lang], s) for i, (s, a, p, x, y) in enumerate(own[:top], 1)]
    return sorted(out)


def told(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def drawn(spark):
    random.seed(9)
    words = [f"w{i}" for i in range(25)] + ["Über", "naïve", "日本", "A-Z"]
    fixed = ["of the order of", "Über alle Maßen", "w1 w2 w3", "w2 w3", "aa aa aa aa aa"]
    texts = [
        "".join(random.choice([*words, *fixed]) + random.choice([" ", " ", " ", "\t", ", ", ".", "\n", "\x0b"]) for _ in range(60))
        for _ in range(80)
    ]
    langs = ["en", "en", "en", None, "de"]
    rows = [(i, t, langs[i % 5], "s", len(t)) for i, t in enumerate(texts)]
    return clashing(documents(spark)).unionByName(
        clashing(spark.createDataFrame(rows, documents(spark).schema)), allowMissingColumns=True
    )


@pytest.mark.parametrize(("least", "nodes", "block", "top"), [(3, 2_000_000, 1 << 21, 2000), (2, 700, 40, 15)])
def test_against_a_plain_count(spark, sf_dir, monkeypatch, least, nodes, block, top):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", block)
    docs = drawn(spark)
    want = plain([(r["lang"], r["text"]) for r in docs.collect()], least, top=top)
    assert told(phrases.collocations(docs, least=least, nodes=nodes, top=top)) == want
    assert len({r[0] for r in want}) == 3


def test_nothing_frequent_and_no_documents(spark):
    docs = documents(spark)
    assert phrases.collocations(docs, least=10**6).count() == 0
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_phrases_of_the_given_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert told(phrases.collocations(docs)) == plain([(r["lang"], r["text"]) for r in docs.collect()], 30)


def test_every_child_of_a_trie_is_found_and_no_other():
    rng = np.random.default_rng(1)
    trie = phrases.no_phrases(300)
    states = np.arange(300)
    told = {(w,): w for w in range(300)}
    for level in (2, 3, 4):
        children = {s: rng.choice(300, rng.choice([1, 1, 1, 2, 40, 299]), replace=False) for s in rng.choice(states, 60, replace=False)}
        parents = np.concatenate([np.full(len(c), s) for s, c in children.items()])
        words = np.concatenate(list(children.values()))
        trie = phrases.grown(trie, parents, words, level)
        for s, c in children.items():
            got = phrases.advanced(trie, np.full(300, s), np.arange(300))
            assert set(np.flatnonzero(got >= 0)) == set(c)
        at = phrases.advanced(trie, parents, words)
        path = {s: p for p, s in told.items()}
        for s, w, t in zip(parents.tolist(), words.tolist(), at.tolist(), strict=True):
            told[(*path[s], w)] = t
        walked = np.stack(phrases.phrase_of(trie, at, 4), axis=1)
        assert [tuple(x for x in r if x >= 0) for r in walked.tolist()] == [(*path[s], w) for s, w in zip(parents.tolist(), words.tolist(), strict=True)]
        states = at
