"""Suffix-array and substring dedup against brute force over all windows."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import backframe.llm.repeats as repeats
import backframe.llm.substrings as substrings
import backframe.llm.suffixes as suffixes
from backframe.llm.common import table
from tests.llm.cases import PROSE, TEXTS, clashing, documents


def plain(rows, split, join, window, inside):
    """(key, units, spans, kept) by marking every window that starts earlier."""
    rows = [(k, split(t or "")) for k, t in rows]
    rank = lambda k: (k is not None, k or 0)
    least = {}
    for k, u in rows:
        for i in range(len(u) - window + 1):
            w = join(u[i : i + window])
            least[w] = min(least.get(w, rank(k)), rank(k))
    out = []
    for k, u in rows:
        gone, seen = [False] * len(u), set()
        for i in range(len(u) - window + 1):
            w = join(u[i : i + window])
            if least[w] < rank(k) or inside and w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        marks = "".join("x" if g else "." for g in gone)
        spans = [(m.start(), len(m[0])) for m in re.finditer("x+", marks)]
        out.append((k, len(u), spans, join([x for x, g in zip(u, gone, strict=True) if not g])))
    return sorted(out, key=repr)


def plain_bytes(rows):
    return plain(rows, lambda t: [bytes([b]) for b in t.encode()], b"".join, 50, False)


def plain_words(rows):
    return plain(rows, lambda t: [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", t)], b" ".join, 20, True)


def shared_texts():
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    draw = lambda n: " ".join(random.choice(words) for _ in range(n))
    passages = [draw(n) for n in (14, 20, 21, 25, 60, 300)]
    texts = [" ".join(random.choice([draw(9), random.choice(passages), p]) for p in passages) for _ in range(60)]
    for p in passages[2:]:
        w = p.split()
        texts += [" ".join(w[i : i + 19 + i % 4]) for i in range(0, len(w) - 22, 7)]
    return [*texts, *TEXTS, "a " * 21, "b c " * 12, PROSE * 3, "é" * 60, "ab" * 40, "ab" * 41, "x" * 49, "x" * 50, "x" * 51]


@pytest.mark.parametrize(("block", "hot"), [(1 << 22, 64), (3000, 64), (3000, 2)])
@pytest.mark.parametrize(("dedup", "brute"), [(suffixes.suffix_dedup, plain_bytes), (substrings.substring_dedup, plain_words)])
def test_against_brute_force(spark, sf_dir, dedup, brute, block, hot, monkeypatch):
    small = table(spark, sf_dir, "documents")
    for docs in (clashing(documents(spark, shared_texts())), small):
        monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
        monkeypatch.setattr(repeats, "HOT_BLOCKS", hot)
        made = dedup(docs)
        got = [(r.doc_id, r.n_units, [tuple(x) for x in r.spans], bytes(r.kept)) for r in made.collect()]
        want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        assert sorted(got, key=repr) == want
        assert any(spans for _, _, spans, _ in want)
    assert dedup(docs.limit(0)).count() == 0


def padded_texts():
    random.seed(12)
    body = [bytes(random.randrange(97, 123) for _ in range(random.randrange(45, 66))).decode() for _ in range(9)]
    pad = ["", "\0", "\0" * 5, "\0" * 9, "\0" * 40, "x", "\0x", "\0" * 5 + "y"]
    return [random.choice(body) + random.choice(pad) + random.choice(["", random.choice(body)]) for _ in range(200)]


def test_texts_padded_with_nuls(spark):
    docs = documents(spark, padded_texts())
    got = [(r.doc_id, r.n_units, [tuple(x) for x in r.spans], bytes(r.kept)) for r in suffixes.suffix_dedup(docs).collect()]
    assert sorted(got, key=repr) == plain_bytes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(50, 58), st.sampled_from(["", "\0", "\0\0\0", "\0a", "a\0"])), min_size=1, max_size=9))
def test_windows_beside_nuls(drawn):
    base = [bytes((7 * k + 3 * i) % 5 for i in range(60)) for k in range(3)]
    texts = [base[k][: n] + tail.encode() for k, n, tail in drawn]
    doc = np.arange(len(texts))
    got = suffixes.repeated_windows(texts, doc, doc[:, None], doc)
    least = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - 49):
            least.setdefault(t[i : i + 50], d)
    assert [g.tolist() for g in got] == [[least[t[i : i + 50]] < d for i in range(len(t) - 49)] for d, t in enumerate(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=3, max_size=14), min_size=1, max_size=8))
def test_maximal_repeats_of_all_suffixes(texts):
    """The groups are the left- and right-maximal repeats, with all their occurrences."""
    suffix = sorted((t[i:], k, i) for k, t in enumerate(texts) for i in range(len(t)))
    common = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    shared = [0, *(common(a[0], b[0]) for a, b in zip(suffix, suffix[1:], strict=False))]
    before = [ord(texts[k][i - 1]) if i else -1 for _, k, i in suffix]
    groups = suffixes.maximal_repeats(shared, before, [k for _, k, _ in suffix], 2, 99)
    got = {suffix[a][0][:n]: ({(k, i) for _, k, i in suffix[a : b + 1]}, d) for a, b, n, d in groups}
    want = {}
    for s in {t[i:j] for t in texts for i in range(len(t)) for j in range(i + 2, len(t) + 1)}:
        at = {(k, i) for k, t in enumerate(texts) for i in range(len(t)) if t.startswith(s, i)}
        left = [texts[k][i - 1] if i else None for k, i in at]
        right = [texts[k][i + len(s) : i + len(s) + 1] or None for k, i in at]
        differ = lambda x: None in x or len(set(x)) > 1
        if len(at) > 1 and differ(left) and differ(right):
            want[s] = (at, min(k for k, _ in at))
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 9))
def test_ranks_are_those_of_sorted_prefixes(words, width):
    ranks = substrings.ranked_prefixes(np.array(words, np.int64), width) if len(words) >= width else []
    got = np.unique(ranks, return_inverse=True)[1]
    prefixes = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    names = {p: k for k, p in enumerate(sorted(set(prefixes)))}
    assert list(got) == [names[p] for p in prefixes]


def test_factors_take_windows_at_their_ends_from_other_sources():
    """A factor stops where its source does; the windows across its end come from elsewhere."""
    a, b = [f"a{i}" for i in range(25)], [f"b{i}" for i in range(25)]
    texts = [" ".join(x).encode() for x in (a, b, [*a[-19:], *b[:19]], [*a, *b], [*a, "new", *b])]
    doc = np.arange(5)
    got = substrings.repeated_windows(texts, doc, np.stack([doc, doc], axis=1), doc)
    assert [g.tolist() for g in got[:3]] == [[False] * 6, [False] * 6, [False] * 19]
    assert got[3].all() and got[4].tolist() == [True] * 6 + [False] * 20 + [True] * 6
