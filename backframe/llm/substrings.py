"""Substring dedup: relative Lempel-Ziv parsing against indexed reference blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from backframe.llm.repeats import Kind, WordUnits, remove_repeats

WINDOW = 20
GRAM = 8


def ranked_prefixes(words: np.ndarray, width: int) -> np.ndarray:
    """The rank of the ``width`` words from each place on, equal ones alike: a suffix array's order.

    Ranks of 1, 2, 4, ... words follow from each other by pairs, those of ``width`` from the last ones.
    Places too near the end are left out.
    """
    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]

    ranks, size, rest = words.astype(np.int64), 1, width
    out, done = None, 0
    while rest:
        if rest & 1:
            own = ranks[done:]
            out = own if out is None else paired(out[: len(own)], own[: len(out)])
            done += size
        rest >>= 1
        if rest:
            ranks, size = paired(ranks[:-size], ranks[size:]), 2 * size
    return out


def sources(ranks: np.ndarray, doc: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each place the first one of its rank that counts as earlier, -1 if there is none.

    Places are in order of document, row and start. Earlier is one of a lesser document, or one before in the
    same row; those in another row of the same key are passed over.
    """
    def first(groups: np.ndarray) -> np.ndarray:
        _, at, group = np.unique(groups, return_index=True, return_inverse=True)
        return at[group]

    here = np.arange(len(ranks))
    lead, own = first(ranks), first(ranks * (int(row.max(initial=0)) + 1) + row)
    return np.where(doc[lead] < doc, lead, np.where(own < here, own, -1))


def factors(at: int, end: int, source: list[int], words: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Greedy parse of the words from ``at`` to ``end``: (first, length) of its factors of a window or more.

    A factor begins where a window has a source in the reference and is carried on, word by word, as
    far as the two agree; windows inside it are not looked up. The next factor begins behind its last
    window, so windows that lie across the end of a factor are not missed, whichever part of the
    reference they come from. ``ends[i]`` is where the reference around place i stops.
    """
    out = []
    while at + WINDOW <= end:
        place = source[at]
        if place < 0:
            at += 1
            continue
        stop, there = at + WINDOW, place + WINDOW
        limit = ends[place]
        while stop < end and there < limit and words[stop] == words[there]:
            stop, there = stop + 1, there + 1
        out.append((at, stop - at))
        at = stop - WINDOW + 1
    return out


def repeated_windows(texts: list[bytes], doc: np.ndarray, rows: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Whether each window of each stretch starts earlier, in a lesser document or the same row.

    The stretches of the bucket, in order of document, row and start, are the reference block. Its
    index is the order of their suffixes by a window's words; each stretch is parsed against what counts as
    earlier there.
    """
    order = np.lexsort((start, rows[:, 1], rows[:, 0], doc))
    split = [texts[which].split(b" ") for which in order.tolist()]
    sizes = np.array([len(w) for w in split])
    stops = np.cumsum(sizes)
    coded = pa.array([w for own in split for w in own], pa.large_binary()).dictionary_encode().indices.to_numpy()
    begins = stops - sizes
    windows = sizes - WINDOW + 1
    place = np.repeat(begins - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    stretch = np.repeat(np.arange(len(order)), windows)
    _, row = np.unique(rows[order], axis=0, return_inverse=True)
    # Windows that hang over the end of a stretch have a rank, too, but are in none of these places.
    found = sources(ranked_prefixes(coded, WINDOW)[place], doc[order][stretch], row.ravel()[stretch])
    source = np.full(len(coded), -1)
    source[place] = np.where(found >= 0, place[found], -1)
    some = np.unique(stretch[found >= 0])
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(texts)
    for which, n in zip(order.tolist(), windows.tolist(), strict=True):
        out[which] = np.zeros(n, bool)
    if len(some):
        words, told, ends = coded.tolist(), source.tolist(), np.repeat(stops, sizes).tolist()
        for k in some.tolist():
            repeats, begin = out[order[k]], int(begins[k])
            for first, length in factors(begin, int(stops[k]), told, words, ends):
                repeats[first - begin : first - begin + length - WINDOW + 1] = True
    return out


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_units, spans, kept) of every document, units being words.

    Removed is each word covered by a window of 20 words that starts earlier: in a document of a
    lesser key, or before in the same document; windows are judged on the input as it stands.
    Rows of one key do not count as before one another. Nulls, other columns and empty tables: see
    ``remove_repeats``.
    """
    return remove_repeats(docs, Kind(WordUnits, WINDOW, GRAM, inside=True), repeated_windows, key, text)
