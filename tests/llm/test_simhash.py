"""SimHash near-duplicates against brute force over all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from backframe.llm.common import table
from backframe.llm.graph import components
from backframe.llm.simhash import links, near_duplicates
from tests.llm.cases import PROSE, clashing, documents


def plain_fingerprint(text, shingle):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, linked):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def plain(rows, shingle, distance):
    prints = [(k, plain_fingerprint(t, shingle)) for k, t in rows]
    values = sorted({p for _, p in prints})
    pairs = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= distance]
    roots = plain_roots(values, pairs)
    least = defaultdict(list)
    for k, p in prints:
        if k is not None:
            least[roots[p]].append(k)
    return sorted(((k, f"{p:016x}", min(least[roots[p]], default=None)) for k, p in prints), key=repr)


@pytest.mark.parametrize(("shingle", "distance"), [(4, 4), (2, 3)])
def test_near_duplicates(spark, sf_dir, shingle, distance):
    edited = [PROSE.replace("tree", f"tree{i}") * 3 for i in range(30)]
    for docs in (clashing(documents(spark)), documents(spark, edited), table(spark, sf_dir, "documents")):
        got = near_duplicates(docs, shingle=shingle, distance=distance).collect()
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert sorted((tuple(r) for r in got), key=repr) == plain(rows, shingle, distance)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_links_connect_every_near_pair(spark):
    random.seed(3)
    centres = [random.getrandbits(64) for _ in range(40)]
    values = set(centres)
    for c in centres:  # a crowd around the first, a few around the others
        for _ in range(400 if c == centres[0] else 6):
            v = c
            for b in random.sample(range(64), random.randint(1, 7)):
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "print long")
    got = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in links(frame).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in got)
    pairs = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 4]
    assert plain_roots(values, got) == plain_roots(values, pairs)


def test_components(spark):
    random.seed(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (1, 500), (500, 3), (3, 1), (None, 2)]
    pairs += [(1000, random.randint(1001, 1400)) for _ in range(300)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    assert got == plain_roots({v for p in real for v in p}, real)
    assert components(frame.limit(0)).count() == 0
