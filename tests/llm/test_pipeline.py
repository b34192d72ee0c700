"""The pipeline stage by stage against brute force, on fixtures and on the smallest table."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from backframe.llm.common import table
from backframe.llm.quality import judge
from backframe.llm.simhash import one_of_each
from tests.llm.cases import clashing, documents
from tests.llm.test_rowwise import hit_figures, packed_rows
from tests.llm.test_simhash import plain


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    by_name = dict(pipeline.STAGES)
    assert list(by_name) == [n for n, _ in pipeline.STAGES] and len(by_name) == 5

    kept = by_name["quality_rules"](spark, docs, sf_dir)
    verdicts = {r.doc_id: r.kept for r in judge(docs).select("doc_id", "quality.kept").collect()}
    assert {r.doc_id for r in kept.collect()} == {k for k, v in verdicts.items() if v} and kept.columns == columns

    single = by_name["simhash_near_dedup"](spark, kept, sf_dir)
    want = {c for _, _, c in plain([(r.doc_id, r.text) for r in kept.collect()], 4, 4)}
    rows = single.collect()
    assert sorted(r.doc_id for r in rows) == sorted(want) and single.columns == columns

    pure = by_name["benchmark_decontamination"](spark, single, sf_dir)
    clean = {r.doc_id for r in rows if not hit_figures(r.text, bench)[4]}
    assert {r.doc_id for r in pure.collect()} == clean and pure.columns == columns and len(clean) < len(rows)

    private = by_name["pii_surrogates"](spark, pure, sf_dir)
    got = private.collect()
    assert {r.doc_id for r in got} == clean and private.columns == columns
    assert all(r.n_chars == len(r.text) for r in got)

    packed = by_name["packing"](spark, private, sf_dir).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed) == packed_rows(private)
    whole = pipeline.run(spark, sf_dir).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, packed))
    fill = defaultdict(int)
    for r in whole:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096


def test_one_row_of_each_group(spark):
    docs = clashing(documents(spark))
    got = one_of_each(docs)
    assert got.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = {c for _, _, c in plain([(r if r is not None else 1 << 62, t) for r, t in rows], 4, 4)}
    assert got.count() == len(groups) == len({r.doc_id for r in got.collect()})
    assert one_of_each(docs.limit(0)).count() == 0


def test_repeated_keys_keep_every_unlike_text(spark):
    """One of the rows that share a key and a text, and each that shares only the key."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (2, c), (3, a), (None, b), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in one_of_each(docs).collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (2, c), (None, None)], key=repr)
