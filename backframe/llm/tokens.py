"""Token ids of whole texts, word by word, with what a worker keeps between tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Words that a worker remembers before it forgets them all.
REMEMBERED = 600_000
#: New words that the library encodes as one line.
AT_ONCE = 8192
#: Words of small letters of ASCII and Latin-1, as UTF-8.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+\Z")
#: A-Z to lower case, all other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class WordEncoder:
    """Ids of texts for a tokenizer that drops white space, splits at it and ignores case.

    The text is cut at ASCII white space; each distinct word is encoded by the library once and
    remembered as little-endian 32-bit ids. Words of plain small letters, which the normalizer
    leaves alone and the pre-tokenizer keeps whole, go to the library in lines past those two
    steps; their ids are told apart by the word-end mark. A point or comma behind such a word is
    a token of its own. Any other word is encoded as it stands.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {b"": b""}
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        suffix = settings["model"]["end_of_word_suffix"]
        settings |= {
            "normalizer": None,
            "added_tokens": [],
            "pre_tokenizer": {
                "type": "Sequence",
                "pretokenizers": [
                    {"type": "WhitespaceSplit"},
                    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
                ],
            },
        }
        self.plain = Tokenizer.from_str(json.dumps(settings))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.marks = {m: self.alone([m])[0] for m in (b".", b",")}

    def forget(self) -> None:
        """Keep only a few of the words, those met first, for the next task."""
        self.known = dict(islice(self.known.items(), REMEMBERED // 12))

    def alone(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8") for w in words]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def learn(self, words: Iterable[bytes]) -> None:
        known, marks = self.known, self.marks
        plain, marked, other = set(), [], []
        for w in words:
            stem = w[:-1] if w[-1:] in marks else w
            if PLAIN.match(stem):
                if stem is not w:
                    marked.append((w, stem))
                if stem not in known:
                    plain.add(stem)
            else:
                other.append(w)
        ordered = list(plain)
        for i in range(0, len(ordered), AT_ONCE):
            some = ordered[i : i + AT_ONCE]
            line = b" ".join(some).decode("utf-8")
            ids = np.array(self.plain.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            cuts = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
            packed = ids.tobytes()
            known.update((w, packed[a:b]) for w, a, b in zip(some, cuts[:-1], cuts[1:], strict=True))
        known.update((w, known[stem] + marks[w[-1:]]) for w, stem in marked)
        known.update(zip(other, self.alone(other), strict=True))

    def encode(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """Ids of all texts one after the other, and where in bytes each text's begin and end.

        Nulls are empty. The words of a batch are numbered by Arrow, so that only the distinct
        ones are looked up here.
        """
        if len(self.known) > REMEMBERED:  # the words met first are the frequent ones
            self.known = dict(islice(self.known.items(), REMEMBERED // 4))
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # Special strings are told apart by case, so a text that may hold one keeps its own.
        folded = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        words = pc.ascii_split_whitespace(folded)
        numbered = words.flatten().dictionary_encode()
        distinct = numbered.dictionary.cast(pa.binary()).to_pylist()
        known = self.known
        self.learn([w for w in distinct if w not in known])
        ids = pa.array([known[w] for w in distinct], pa.binary()).take(numbered.indices)
        if not len(ids):
            return memoryview(b""), np.zeros(len(texts) + 1, np.int64)
        offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        return memoryview(ids.buffers()[2] or b""), offsets[words.offsets.to_numpy()].astype(np.int64)
