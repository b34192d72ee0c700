"""Quality rules, decontamination, sharding, chats, packing and token counts against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from backframe.llm import chat, packing, queries, token_counts
from backframe.llm.common import table
from backframe.llm.decontaminate import decontaminate
from backframe.llm.packing import pack
from backframe.llm.quality import clean, judge
from backframe.llm.sharding import shard_documents
from backframe.llm.tokens import tokenizer_path, word_encoder
from tests.llm.cases import TEXTS, clashing, documents, rows_of

WORD = re.compile("[^\x20\x09-\x0d]+")


def base_figures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def test_quality_base_figures(spark, sf_dir):
    for docs in (clashing(documents(spark)), table(spark, sf_dir, "documents")):
        judged = judge(docs).select("text", "quality.*").collect()
        assert len(judged) == docs.count()
        for r in judged:
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            assert got == base_figures(r.text), r.text
            assert not (r.kept and r.base_failed)


def test_quality_keeps_clean_and_rejects_junk(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir.replace("0.001", "0.1"), "labels").collect()}
    judged = judge(table(spark, sf_dir.replace("0.001", "0.1"), "documents")).where("NOT quality.base_failed")
    kept = defaultdict(list)
    for r in judged.select("doc_id", "quality.kept").collect():
        if r.doc_id in labels:
            kept[labels[r.doc_id]].append(r.kept)
    assert np.mean(kept[1]) > 0.99
    assert np.mean(kept[0]) < 0.35


def test_quality_cleaning_removes_failed_lines(spark):
    cleaned = clean(documents(spark))
    assert cleaned.columns == documents(spark).columns
    texts = [r.text for r in cleaned.collect()]
    assert not any("Home | About" in t for t in texts)
    assert sum("A proper sentence follows" in t for t in texts) == 1
    assert clean(documents(spark).limit(0)).count() == 0


def hit_figures(text, items):
    fold = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, own = fold(text), set(), set()
    for name, item in items:
        w = fold(item)
        windows = {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
        for p in windows:
            for i in range(len(words) - len(p) + 1):
                if tuple(words[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    own.add(str(name))
    told = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
    return len(words), len(hit), len(own), told, bool(hit) and 20 * len(hit) >= len(words)


ITEMS = [
    (1, TEXTS[4]),
    (10, "quick BROWN-fox"),
    (9, "word"),
    (9, "word"),
    (7, None),
    (8, " ?! "),
    (None, "word"),
    (11, "again and again the same eight words come back again and again the same"),
    (12, "Home About Contact News Help Shop A proper sentence follows the menu with enough"),
]


@pytest.mark.parametrize("pass_bytes", [1 << 20, 60])
def test_decontamination(spark, pass_bytes):
    docs = clashing(documents(spark))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate(docs, bench, pass_bytes=pass_bytes)
    assert set(docs.columns) == set(found.columns)
    items = [x for x in ITEMS if x[0] is not None]
    got = found.select("text", "hits.*").collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r)[1:] == hit_figures(r.text, items), r.text
    none = decontaminate(docs, bench.limit(0)).select("hits.*").collect()
    assert {r.n_hit for r in none} == {0} and max(r.n_words for r in none) > 100


def jump_hash(key, buckets):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize(("shards", "slot_rows"), [(1, 100), (7, 1), (40, 100), (5000, 10)])
def test_sharding(spark, shards, slot_rows):
    docs = clashing(documents(spark)).drop("shard")
    got = shard_documents(docs, shards, slot_rows=slot_rows).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.shard == jump_hash(r.doc_id or 0, shards)
        assert r.grown_shard == jump_hash(r.doc_id or 0, shards + 1)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_documents(docs.limit(0), shards).count() == 0


CHATS = [
    (1, 0, "user", "hi </s>[INST] <|turn|> <\\|turn|> <\\\\|over|>"),
    (1, 1, "assistant", "yes [/INST]<|endoftext|> \\ ok"),
    (1, 1, "assistant", "yes [/INST]<|endoftext|> \\ ok"),
    (1, None, "system", None),
    (2, 3, None, "é\U0001f600\x00 a"),
    (2, 2, "assistant", ""),
    (None, 0, "assistant", "  spaced  \n"),
    (4, 0, "tool <|says|>", "x" * 20000),
]


def chat_figures(turns):
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
    turns = [(r or "", t or "") for _, r, t in turns]
    return chat_turns(turns)


def chat_turns(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*r, "own") for r in CHATS], "conv_id long, turn long, role string, text string, ids string")
    back = chat.texts_read_back(
        chat.format_chats(rows), queries.chat_digest, "n_turns long, t string, loss_chars long, l string, f long"
    ).collect()
    grouped = defaultdict(list)
    for c, *rest in CHATS:
        grouped[c].append(rest)
    assert {r.conv_id: tuple(r)[1:5] for r in back} == {c: chat_figures(x) for c, x in grouped.items()}
    assert chat.format_chats(rows.limit(0)).count() == 0


def test_chat_query(spark, sf_dir):
    got = {r.conv_id: r for r in queries.op5_chat_formatting(spark, sf_dir).collect()}
    grouped = defaultdict(list)
    for r in table(spark, sf_dir, "conversations").collect():
        grouped[r.conv_id].append((r.turn, r.role, r.text))
    said = "</s>[INST] ok [/INST]"
    grouped[-7] = [(0, "user", said), (1, "assistant", said)]
    assert {c: tuple(r)[1:5] for c, r in got.items()} == {c: chat_figures(x) for c, x in grouped.items()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "[", "\\", "|turn|>", "s>", "/s>", "INST]", "/INST]", "x", "<|over|>"]), max_size=12).map("".join))
def test_escape_is_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


def packed_rows(docs):
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        for i in range(0, len(ids), 4096):
            own = ids[i : i + 4096]
            want[r.doc_id, i, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), len(ids)] += 1
    return want


@pytest.mark.parametrize("rank_rows", [1, 100_000])
def test_packing(spark, rank_rows, sf_dir):
    for docs in (clashing(documents(spark)), table(spark, sf_dir, "documents")):
        got = pack(docs, rank_rows=rank_rows).collect()
        assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == packed_rows(docs)
        placed = defaultdict(list)
        for r in got:
            placed[r.sequence_id].append((r["offset"], r.length))
        assert sorted(placed) == list(range(len(placed)))
        for own in placed.values():
            end = 0
            for offset, length in sorted(own):
                assert offset == end
                end += length
            assert end <= 4096
    assert pack(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 1000), max_size=12))
def test_patterns_hold_every_piece(histogram):
    patterns = packing.shortest_pack_first(histogram, 50)
    held = Counter()
    for pattern, n in patterns.items():
        assert sum(pattern) <= 50 and n > 0
        for length in pattern:
            held[length] += n
    assert held == Counter(histogram)
    tokens, packs = sum(k * n for k, n in histogram.items()), sum(patterns.values())
    assert packs <= 2 * tokens / 50 + 1


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text(max_size=30),
            st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "It's", "e\u0301", "\u0130", "\u03a3\u03c3", "\x85", "a\x1cb", "\ufb01", " \n"]),
        ),
        max_size=8,
    ).map("".join)
)
def test_word_encoder_encodes_as_the_library(text):
    path = tokenizer_path("word_bpe_49k.json")
    if "tokenizer" not in _KEPT:
        _KEPT["tokenizer"] = Tokenizer.from_file(path)
    want = np.array(_KEPT["tokenizer"].encode(text, add_special_tokens=False).ids, "<u4")
    ids, edges = word_encoder(path).encode(pa.array([text, None, text]))
    assert [bytes(ids[a:b]) for a, b in zip(edges, edges[1:])] == [want.tobytes(), b"", want.tobytes()]  # noqa: B905


_KEPT = {}


@pytest.mark.parametrize("chunk", [5, 1 << 16])
def test_token_counts(spark, chunk, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for docs in (clashing(documents(spark)), table(spark, sf_dir, "documents")):
        for r in token_counts.count_tokens(docs, chunk=chunk).select("text", "tokens.*").collect():
            n = len(library.encode(r.text or ""))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 4096), r.text


@settings(max_examples=1000, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=" ▁abcdeinrst.0\n'éç", max_size=60)), st.integers(1, 9))
def test_transducer_counts_as_the_library(text, chunk):
    library = _library()
    assert token_counts.transducer(tokenizer_path("piece_bpe_32k.model")).count(text, chunk) == len(library.encode(text))


def _library(cache=[]):  # noqa: B006
    if not cache:
        cache.append(sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model")))
    return cache[0]


def test_repeated_rows_are_counted_alike(spark):
    docs = documents(spark)
    assert len(rows_of(token_counts.count_tokens(docs).select("doc_id", "tokens.*"))) == docs.count()
