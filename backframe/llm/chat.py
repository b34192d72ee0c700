"""Chat formatting at the level of token ids, with control strings escaped in content."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from backframe.llm.common import python_ready
from backframe.llm.tokens import tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
#: Texts that a worker encodes, and conversations that it assembles, at once.
AT_ONCE = 128
#: The template's marks; their ids follow the vocabulary's in this order.
HEAD, BODY, END = MARKS = ("<|turn|>", "<|says|>", "<|over|>")
#: Control strings of common templates, kept out of content as well.
CONTROLS = (
    *MARKS,
    "<|endoftext|>",
    "<|im_end|>",
    "<|im_start|>",
    "<|startoftext|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
)
#: Every control string begins with one of these and has none further on, so no two overlap.
OPENERS = "<["
_ENDS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(rf"([<\[]\\*)(?={_ENDS})")
_UNESCAPE = re.compile(rf"([<\[]\\*)\\(?={_ENDS})")


def escape(text: str) -> str:
    """A backslash more behind the opener of each control string, be it escaped already or not."""
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@lru_cache(maxsize=4)
def content_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def encode(tokenizer: Tokenizer, texts: list[str]) -> list[np.ndarray]:
    out = []
    for i in range(0, len(texts), AT_ONCE):
        some = tokenizer.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)
        out += [np.array(e.ids, np.int32) for e in some]
    return out


def assemble(turns: list[tuple[str, list[int], list[int]]], first_mark: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of a conversation of (role, ids of the role, ids of the text).

    The mask is a prefix sum over +1 where an assistant's text begins and -1 where it ends.
    """
    head, body, end = ([first_mark + i] for i in range(len(MARKS)))
    segments, lengths, steps = [], [], []
    for role, role_ids, text_ids in turns:
        segments += [head, role_ids, body, text_ids, end]
        lengths += [1, len(role_ids), 1, len(text_ids), 1]
        steps.append(role == "assistant")
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    ids = np.concatenate([np.asarray(s, np.int32) for s in segments]) if segments else np.zeros(0, np.int32)
    edge = np.zeros(len(ids) + 1, np.int64)
    for turn, loss in enumerate(steps):
        if loss:
            edge[starts[5 * turn + 3]] += 1
            edge[starts[5 * turn + 4]] -= 1
    return ids, np.cumsum(edge)[:-1].astype(np.int8)


def format_chats(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(conv_id, input_ids, loss_mask) of each conversation.

    A turn is the turn mark, its role, the says mark, its text, the over mark. Role and text are
    escaped, then encoded each for itself, row by row, before any shuffle; the marks are reserved
    ids that no text can yield. The loss lies on the texts of assistants alone. Turns go by
    number, nulls first, ties by role and text; repeated rows are repeated turns. A null role or
    text is empty; a null conv_id is a conversation like any other. Other columns are left out.
    A conversation is one sequence, so it must fit in a task. No rows give no conversations.
    """
    spark = conversations.sparkSession
    python_ready(spark)
    path = tokenizer_path(tokenizer)
    words = "role_ids array<int>, text_ids array<int>"

    @F.pandas_udf(words)
    def segments(roles: pd.Series, texts: pd.Series) -> pd.DataFrame:
        own = content_tokenizer(path)
        return pd.DataFrame(
            {"role_ids": encode(own, [escape(r) for r in roles]), "text_ids": encode(own, [escape(t) for t in texts])}
        )

    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("ids", segments("role", "text"))
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("turn", "role", "text", "ids")),
            lambda a, b: F.when(a["turn"].eqNullSafe(b["turn"]) & (a["role"] == b["role"]),
                                F.when(a["text"] < b["text"], -1).when(a["text"] > b["text"], 1).otherwise(0))
            .when(a["turn"].eqNullSafe(b["turn"]), F.when(a["role"] < b["role"], -1).otherwise(1))
            .when(a["turn"].isNull() | (a["turn"] < b["turn"]), -1)
            .otherwise(1),
        ).alias("turns")
    ).select(
        "conv_id",
        F.col("turns.role").alias("roles"),
        F.col("turns.ids.role_ids").alias("role_ids"),
        F.col("turns.ids.text_ids").alias("text_ids"),
    )
    out = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, input_ids array<int>, loss_mask array<tinyint>"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_mark = content_tokenizer(path).get_vocab_size()
        for whole in batches:
            for i in range(0, len(whole), AT_ONCE):
                batch = whole.slice(i, AT_ONCE)
                made = [
                    assemble(list(zip(*turns, strict=True)), first_mark)
                    for turns in zip(*(batch.column(k).to_pylist() for k in range(1, 4)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([ids for ids, _ in made], pa.list_(pa.int32())),
                        pa.array([mask for _, mask in made], pa.list_(pa.int8())),
                    ],
                    names=["conv_id", "input_ids", "loss_mask"],
                )

    return grouped.mapInArrow(join, out)


def read_back(ids: np.ndarray, mask: np.ndarray, tokenizer: Tokenizer) -> tuple[list[tuple[str, str]], str, str]:
    """Turns, text under the loss mask and formatted text, from the ids alone."""
    first = tokenizer.get_vocab_size()
    marks = np.flatnonzero(ids >= first)
    decode = lambda a, b: tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False)
    parts = [decode(a + 1, b) for a, b in zip(marks[:-1], marks[1:], strict=True)]
    turns = [(unescape(parts[i]), unescape(parts[i + 1])) for i in range(0, len(marks) - 1, 3)]
    loss = []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        loss.append(unescape(decode(a, b)))
    shown = "".join(MARKS[ids[m] - first] + part for m, part in zip(marks, [*parts, ""], strict=True))
    return turns, "".join(loss), shown


def texts_read_back(chats: DataFrame, digest, schema: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``digest(turns, loss text, formatted text)`` of each formatted conversation, as columns."""
    path = tokenizer_path(tokenizer)

    @F.pandas_udf(schema)
    def read(ids: pd.Series, mask: pd.Series) -> pd.DataFrame:
        own = content_tokenizer(path)
        names = [part.split()[0] for part in schema.split(",")]
        return pd.DataFrame([digest(*read_back(i, m, own)) for i, m in zip(ids, mask, strict=True)], columns=names)

    return chats.select("conv_id", read("input_ids", "loss_mask").alias("back")).select("conv_id", "back.*")
