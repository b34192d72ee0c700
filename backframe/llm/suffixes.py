"""Suffix-array dedup: maximal repeats from the interval tree of an enhanced suffix array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from backframe.llm.repeats import ByteUnits, Kind, remove_repeats

WINDOW = 50
GRAM = 32
#: Bytes by which suffixes are sorted, and the longest common prefix that is told. A stretch under
#: one anchor is seldom longer.
DEPTH = 72
UNKNOWN, DIVERSE = -1, -2


def windows_met_again(eight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places of the windows whose first 48 bytes another window begins with too, and perhaps a few more.

    All others share too little with any suffix to be part of a repeat.
    """
    hashes = np.zeros(len(start), np.uint64)
    for at in range(0, WINDOW - 7, 8):
        hashes = (hashes ^ eight[start + at].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    order = np.argsort(hashes)
    same = np.concatenate([[False], np.diff(hashes[order]) == 0, [False]])
    return np.sort(order[same[1:] | same[:-1]])


def suffix_array(data: np.ndarray, start: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``start`` that may share a window, and what each shares with the one before.

    ``room`` is how far a suffix reaches, a window at least. One that ends where another goes on
    stands before it, whatever bytes follow there. All others are no part of any repeat and left out.
    """
    padded = np.concatenate([data, np.zeros(DEPTH + 8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), ">u8", padded, 0, (1,))
    some = windows_met_again(eight, start)
    start, room = start[some], room[some]
    words = []
    for at in range(0, DEPTH, 8):
        left = np.clip(room - at, 0, 8)
        mask = np.where(left > 0, ~np.uint64(0) << (np.uint64(8) * (8 - np.maximum(left, 1)).astype(np.uint64)), 0)
        words.append(eight[start + at].astype(np.uint64) & mask.astype(np.uint64))
    order = np.lexsort([room, *words[::-1]])
    shared = np.full(len(order), 0, np.int64)
    going = np.ones(max(len(order) - 1, 0), bool)
    for word in words:
        own = word[order]
        differ = own[1:] ^ own[:-1]
        same = sum((differ < np.uint64(1 << bits)).astype(np.int64) for bits in range(0, 64, 8))
        shared[1:] += np.where(going, same, 0)
        going &= differ == 0
    reach = room[order]
    shared[1:] = np.minimum(shared[1:], np.minimum(reach[1:], reach[:-1]))
    return some[order], shared


def maximal_repeats(
    shared: list[int], left: list[int], doc: list[int], least: int, most: int
) -> list[tuple[int, int, int, int]]:
    """(first, last, length, least document) of the groups of a suffix array.

    A scan with a stack visits the intervals of suffixes with a common prefix of ``least`` bytes
    or more, each after those inside it. One is a maximal repeat if the bytes before its suffixes
    differ, or one is not known; else all of it can be extended to the left, and the repeat that
    begins there tells as much. Prefixes of ``most`` bytes may be longer than is known, so all of
    them are told.
    """
    out = []
    stack: list[list[int]] = []  # [length, first, least document, byte before]
    for i in range(1, len(shared) + 1):
        length = shared[i] if i < len(shared) else 0
        first, own_doc, own_left = i - 1, doc[i - 1], left[i - 1]
        while stack and length < stack[-1][0]:
            top = stack.pop()
            if own_doc < top[2]:
                top[2] = own_doc
            if top[3] != own_left or own_left < 0:
                top[3] = DIVERSE
            if top[3] == DIVERSE or top[0] >= most:
                out.append((top[1], i - 1, top[0], top[2]))
            first, own_doc, own_left = top[1], top[2], top[3]
        if length < least:
            continue
        if stack and length == stack[-1][0]:
            top = stack[-1]
            if own_doc < top[2]:
                top[2] = own_doc
            if top[3] != own_left or own_left < 0:
                top[3] = DIVERSE
        else:
            stack.append([length, first, own_doc, own_left])
    return out


def least_documents(texts: list[bytes], doc: np.ndarray) -> list[np.ndarray]:
    """For each window of each distinct text, the least document that has it."""
    sizes = np.array([len(t) for t in texts])
    counts = sizes - WINDOW + 1
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (ends - sizes)[owner] + inside
    order, shared = suffix_array(data, start, sizes[owner] - inside)
    before = np.where(inside > 0, data[np.maximum(start - 1, 0)].astype(np.int64), UNKNOWN)
    out = doc[owner].copy()
    # Suffixes that share enough with neither neighbour are no part of any repeat.
    enough = shared >= WINDOW
    some = np.flatnonzero(enough | np.append(enough[1:], False))
    if len(some):
        own = order[some]
        groups = maximal_repeats(shared[some].tolist(), before[own].tolist(), out[own].tolist(), WINDOW, DEPTH)
        if groups:
            first, last, length, least = np.array(groups, np.int64).T
            each = last - first + 1
            place = np.repeat(first - (np.cumsum(each) - each), each) + np.arange(each.sum())
            window, least, length = own[place], np.repeat(least, each), np.repeat(length, each)
            for further in range(DEPTH - WINDOW + 1):
                reach = length - WINDOW >= further
                np.minimum.at(out, window[reach] + further, least[reach])
    return np.split(out, np.cumsum(counts)[:-1])


def repeated_windows(texts: list[bytes], doc: np.ndarray, rows: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Whether each window of each text is in a document before the text's own."""
    same = pa.array(texts, pa.binary()).dictionary_encode()
    code = same.indices.to_numpy()
    distinct = same.dictionary.to_pylist()
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, code, doc)
    found = least_documents(distinct, least)
    return [found[c] < d for c, d in zip(code.tolist(), doc.tolist(), strict=True)]


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_units, spans, kept) of every document, units being UTF-8 bytes.

    Removed is what windows of 50 bytes cover that also start in a document of a lesser key, in
    the input as it stands. Repeats inside one document, and between rows of one key, stay. Nulls,
    other columns and empty tables: see ``remove_repeats``.
    """
    return remove_repeats(docs, Kind(ByteUnits, WINDOW, GRAM, inside=False), repeated_windows, key, text)
