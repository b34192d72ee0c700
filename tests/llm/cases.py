"""Small tables with the awkward cases, and helpers for comparing with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while nine old owls watch from a tall oak tree near the mill"
TEXTS = [
    None,
    "",
    " \t\n ",
    "word",
    PROSE + ".",
    PROSE + ".",
    PROSE.upper() + "!",
    "A first line of its own.\n" + PROSE + " and more besides.",
    ("again and again the same eight words come back. " * 40).strip(),
    "\n".join(f"Line {i} stands here to say a little thing." for i in range(300)),
    "Grüße — ça va? наука и жизнь 日本語のテキスト \U0001f600 é ﬁn x y\x1cz",
    "Home | About | Contact | News | Help | Shop\nA proper sentence follows the menu with enough words to be "
    "kept by every rule that there is for lines like it.",
    "x" * 5000,
    "a " * 3000,
    " ".join(f"w{i % 997}x{i}" for i in range(6000)),
]


def documents(spark: SparkSession, texts: list[str | None] = TEXTS) -> DataFrame:
    """Ids from 3 in steps of 2, with one row repeated in whole and one without id."""
    rows = [(3 + 2 * i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[4], (None, PROSE, None, None, None), (-5, "minus five\nminus five", "en", "s", 21)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(docs: DataFrame) -> DataFrame:
    """The documents with further columns whose names the operators use themselves."""
    names = (
        "quality", "hits", "tokens", "size", "shard", "slot", "words", "name", "body", "chunk", "rank", "run",
        "hit_mask", "token_count", "fingerprint", "component_id", "length", "start", "key", "bucket", "entities",
    )
    return docs.select("*", *[F.lit("own").alias(n) for n in names])


def rows_of(frame: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
