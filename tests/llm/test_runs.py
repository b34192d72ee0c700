"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import backframe.llm.queries as queries
import backframe.llm.runs as runs
from backframe.llm.common import table
from tests.llm.cases import TEXTS, clashing, documents


def plain_runs(words, least=12):
    """(start, length, period) of maximal stretches, smallest period only."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_kept(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def plain_planted(key, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    return words


def plain_row(key, text):
    words = plain_planted(key, text)
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    told = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    return (key, len(found), *told, sha(lines), sha(" ".join(plain_kept(words, found))))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=5), st.sampled_from([2, 12]))
def test_runs_of_small_alphabets(texts, least):
    codes = np.array([w for t in texts for w in t], np.int64)
    ends = np.cumsum([len(t) for t in texts])
    got = [tuple(r) for r in runs.find_runs(codes, ends, least).tolist()]
    want = []
    for t, end in zip(texts, ends.tolist(), strict=True):
        want += [(end - len(t) + a, end - len(t) + a + n, q) for a, n, q in plain_runs(t, least)]
    assert sorted(got) == sorted(want)


def test_nested_and_long_periods():
    random.seed(5)
    for _ in range(60):
        block = [random.randrange(50) for _ in range(random.randrange(1, 90))]
        inner = block[:5] * random.randrange(1, 7)
        words = [random.randrange(9) for _ in range(40)] + (block + inner) * random.randrange(2, 5) + block[:7]
        found = runs.find_runs(np.array(words), np.array([len(words)]))
        assert [(a, b - a, q) for a, b, q in found.tolist()] == plain_runs(words)


def test_hashes_that_fall_together(monkeypatch):
    """Catches of unlike blocks do no harm."""
    monkeypatch.setattr(runs, "mixed", lambda a, b: (a + b) % np.uint64(2))
    random.seed(6)
    for _ in range(40):
        words = [random.randrange(4) for _ in range(60)] + [1, 2, 3] * random.randrange(2, 9)
        found = runs.find_runs(np.array(words), np.array([len(words)]))
        assert {(a, b - a, q) for a, b, q in found.tolist()} <= set(plain_runs(words))


def test_query_against_brute_force(spark, sf_dir, monkeypatch, tmp_path):
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").collect()
    assert got == {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in rows}
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(runs, "LOT_WORDS", 700)
    docs = clashing(documents(spark, [*TEXTS, "Hey ho " * 9 + "let us go " * 4])).withColumnRenamed("quality", "PERIODIC")
    made = runs.periodic_runs(docs).collect()
    for r in made:
        words = re.findall("[^\x20\x09-\x0d]+", r["text"] or "")
        found = plain_runs(words) if len(words) < 3100 else []
        assert r["periodic"]["n_words"] == len(words)
        assert [tuple(x) for x in r["periodic"]["runs"]] == found
        assert r["periodic"]["collapsed"] == " ".join(plain_kept(words, found))
    assert len(made) == docs.count()
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_a_very_long_run():
    words = np.concatenate([np.arange(1000), np.tile(np.arange(7), 30_000), np.arange(100)])
    assert runs.find_runs(words, np.array([len(words)])).tolist() == [[1000, 211_007, 7]]
