"""Token counts by a finite-state transducer compiled from a piece vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backframe.llm.common import fresh_name, python_ready
from backframe.llm.tokens import REMEMBERED, tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Characters of a chunk of a long text.
CHUNK = 1 << 16
#: States that a worker keeps before it compiles them anew.
MOST_STATES = 500_000
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Chunk(NamedTuple):
    """State map of a stretch of text.

    A word mark after anything but a mark resets the transducer: from there on, the state hangs
    on nothing before. So the map from the state at the start to the state at the end, with the
    tokens emitted, is told by three things: ``head``, the text up to the first reset, which may
    continue a word from outside; ``inner``, the tokens of the words that begin and end inside;
    and ``last``, the word that goes on outside, None if no reset occurs.
    """

    head: str
    inner: int
    last: str | None


class Transducer:
    """Counts the pieces of byte-pair segmentation, one character at a time.

    After each character the segmentation of the prefix ends in one piece. It is the longest one
    that matches there and that is compatible with the piece before it: two pieces are if the
    segmentation of their concatenation is the two. A state is the longest suffix that begins a
    piece, with the last piece of each prefix that ends inside it, and the tokens of the last
    prefix less those of each former; it is finite, as pieces are short. A transition emits the
    difference of the counts. States are made when first reached and numbered.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        ordinary = [
            i for i in range(n)
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))
        ]
        self.rank = {self.model.id_to_piece(i): -self.model.get_score(i) for i in ordinary}
        self.begins = {p[:k] for p in self.rank for k in range(1, len(p) + 1)}
        self.longest = max(map(len, self.rank))
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        #: Numbers of states, what each is, and per state: character -> (state, emitted).
        self.number: dict[tuple, int] = {("", ("",), (0,)): 0}
        self.meaning: list[tuple] = [("", ("",), (0,))]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def merged(self, text: str) -> list[str]:
        """Byte-pair segmentation of a short text: the best pair, leftmost first, until none."""
        parts = list(text)
        while True:
            best = min(
                ((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank),
                default=None,
            )
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def compatible(self, a: str, b: str) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            known = self.fits[a, b] = self.merged(a + b) == [a, b]
        return known

    def step(self, state: int, char: str) -> tuple[int, int]:
        """The next state and the tokens emitted, which may be none or fewer than none."""
        suffix, lasts, counts = self.meaning[state]
        if char not in self.rank:  # in pieces of single bytes; nothing joins with it
            move = (0, len(char.encode("utf-8", "surrogatepass")))
            self.moves[state][char] = move
            return move
        grown = suffix + char
        # Place i of lasts and counts belongs to the prefix that ends after i characters of suffix.
        last, count = char, counts[-1] + 1
        for k in range(min(len(grown), self.longest), 0, -1):
            piece = grown[len(grown) - k :]
            before = len(grown) - k
            if piece in self.rank and self.merged_alone(piece) and (not lasts[before] or self.compatible(lasts[before], piece)):
                last, count = piece, counts[before] + 1
                break
        lasts, counts = (*lasts, last), (*counts, count)
        keep = next((k for k in range(min(len(grown), self.longest), 0, -1) if grown[len(grown) - k :] in self.begins), 0)
        cut = len(grown) - keep
        meaning = (grown[cut:], lasts[cut:], tuple(c - count for c in counts[cut:]))
        target = self.number.get(meaning)
        if target is None:
            target = self.number[meaning] = len(self.meaning)
            self.meaning.append(meaning)
            self.moves.append({})
        move = (target, count - counts[-2])
        self.moves[state][char] = move
        return move

    @lru_cache(maxsize=None)  # noqa: B019  one transducer per worker, at most a value per piece
    def merged_alone(self, piece: str) -> bool:
        return self.merged(piece) == [piece]

    def count_word(self, word: str) -> int:
        """Tokens of a word with its marks; the transducer starts in its first state."""
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.meaning) > MOST_STATES:
            self.reset()
        if len(self.words) > REMEMBERED:
            self.words.clear()
        state, total = 0, 0
        for char in word:
            move = self.moves[state].get(char)
            state, emitted = move or self.step(state, char)
            total += emitted
        if len(word) < 64:
            self.words[word] = total
        return total

    def count_words(self, words: list[str]) -> int:
        return sum(map(self.count_word, words))

    def chunk(self, text: str) -> Chunk:
        """State map of marked text."""
        words = WORD.findall(text)
        if len(words) > 1:
            return Chunk(words[0], self.count_words(words[1:-1]), words[-1])
        return Chunk(text, 0, None)

    def compose(self, a: Chunk, b: Chunk) -> Chunk:
        """The map of two stretches, one after the other; associative."""
        if a.last is None:
            joined = self.chunk(a.head + b.head)
            if b.last is None:
                return joined
            rest = self.count_word(joined.last) if joined.last is not None else 0
            return Chunk(joined.head, joined.inner + rest + b.inner, b.last)
        words = WORD.findall(a.last + b.head)
        if b.last is None:
            return Chunk(a.head, a.inner + self.count_words(words[:-1]), words[-1])
        return Chunk(a.head, a.inner + self.count_words(words) + b.inner, b.last)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text: maps of its chunks, composed pairwise up to one."""
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        if len(marked) <= chunk:
            return self.count_words(WORD.findall(marked))
        maps = [self.chunk(marked[i : i + chunk]) for i in range(0, len(marked), chunk)]
        while len(maps) > 1:
            paired = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = paired + maps[len(maps) - len(maps) % 2 :]
        whole = maps[0]
        return self.count_word(whole.head) + whole.inner + (self.count_word(whole.last) if whole.last else 0)


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(
    docs: DataFrame, text: str = "text", model: str = MODEL, limit: int = 4096, chunk: int = CHUNK
) -> DataFrame:
    """The documents with a struct ``tokens`` (n_bytes, n_tokens, over_limit).

    A null text is empty and has no tokens. Rows are counted one by one, repeated ones alike; a
    column ``tokens`` of the input is replaced. Only the texts go to the workers.
    """
    python_ready(docs.sparkSession)
    path = tokenizer_path(model)

    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = transducer(path)
        for batch in texts:
            yield pd.Series([own.count(t, chunk) if isinstance(t, str) else 0 for t in batch], dtype="int64")

    tokens = counted(F.col(f"`{text}`"))
    n_bytes = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    counts = fresh_name(docs, "token_count")
    return (
        docs.withColumn(counts, tokens)
        .withColumn(
            "tokens",
            F.struct(
                n_bytes.alias("n_bytes"),
                F.col(counts).alias("n_tokens"),
                (F.col(counts) > limit).alias("over_limit"),
            ),
        )
        .drop(counts)
    )
