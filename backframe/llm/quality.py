"""Line-first cleaning: rules per line, then a verdict on what is left of the document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backframe.llm.common import WORD_GAP, let, settled, words_of

#: Marks that end a sentence, closing quotes and brackets after them allowed.
SENTENCE_END = r"""[.!?:;…。！？]["'”’»)\]]*\s*$"""
#: Marks between the entries of a menu.
MENU_MARK = r"[|»›·•→>]"
#: Symbols counted by the base statistics.
SYMBOLS = "#*$%&|<>"
#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "click here to",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign in to",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "use of cookies",
)
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """Bounds of the line rules and of the verdict on the document.

    A line without a sentence end fails if it has fewer words than ``open_line_words``; a line
    whose share of words that are or carry menu marks, or end in odd punctuation, reaches a bound
    fails; a line of page furniture fails if it is shorter than ``boilerplate_chars``. A document fails that loses more than
    ``most_lost`` of its word characters.
    """

    open_line_words: int = 8
    menu_share: float = 0.2
    odd_share: float = 0.3
    boilerplate_chars: int = 250
    most_lost: float = 0.4
    least_words: int = 20
    most_repeat_percent: int = 30


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_failure(line: Column, rules: LineRules) -> Column:
    """Name of the first rule that a line breaks; null if it keeps them all."""
    words = matches(line, r"[^\x20\x09-\x0D]+")
    menu = matches(line, rf"(^|[\x20\x09-\x0D]){MENU_MARK}+(?=[\x20\x09-\x0D]|$)")
    odd = matches(line, r"([#*$%&~^_=+]{2,}|!!+|\?\?+)(?=[\x20\x09-\x0D]|$)")
    furniture = F.lower(line).rlike("|".join(BOILERPLATE))
    # A cheap test stands before each dear one.
    return (
        F.when(line.rlike(MENU_MARK) & (menu >= rules.menu_share * words), F.lit("navigation"))
        .when(line.rlike(r"[#*$%&~^_=+!?]{2}") & (odd >= rules.odd_share * words), F.lit("punctuation"))
        .when(~line.rlike(SENTENCE_END) & (words < rules.open_line_words), F.lit("punctuation"))
        .when((F.length(line) < rules.boilerplate_chars) & furniture, F.lit("boilerplate"))
    )


def repeated_words(words: Column) -> Column:
    """Words covered by windows of eight that are found twice or more in the array.

    Hashes of the windows tell the many documents without any repeat; only the others sort their
    windows, as text, so that equal hashes of different windows do no harm. In the sorted array,
    one fold finds the windows with an equal neighbour; in the array of their starts, another
    adds up the words that they cover.
    """
    n = F.size(words)
    at = lambda i, k: F.get(words, i + k)
    starts = F.sequence(F.lit(0), n - WINDOW)

    def doubled(hashes: Column, span: int) -> Column:
        """Hashes of twice as many words from hashes of ``span`` words."""
        return let(hashes, lambda h: F.zip_with(h, F.slice(h, span + 1, n), lambda x, y: F.xxhash64(x, y)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for span in (1, 2, 4):
        hashes = doubled(hashes, span)
    some = F.size(F.array_distinct(F.slice(hashes, 1, n - (WINDOW - 1)))) < n - (WINDOW - 1)
    ordered = F.array_sort(
        F.transform(
            starts,
            lambda i: F.struct(
                F.concat_ws(" ", *[at(i, k) for k in range(WINDOW)]).alias("window"),
                i.alias("start"),
            ),
        )
    )
    neighbours = let(
        ordered,
        lambda own: F.transform(
            starts,
            lambda j: F.when(
                F.get(own, j)["window"].eqNullSafe(F.get(own, j - 1)["window"])
                | F.get(own, j)["window"].eqNullSafe(F.get(own, j + 1)["window"]),
                F.get(own, j)["start"],
            ),
        ),
    )
    covered = F.aggregate(
        F.array_sort(F.array_compact(neighbours)),
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["words"] + s + WINDOW - F.greatest(s, a["end"])).alias("words"),
            (s + WINDOW).alias("end"),
        ),
        lambda a: a["words"],
    )
    return F.when(n < WINDOW, 0).when(some, covered).otherwise(0).cast("long")


def judge(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """The documents with ``base`` and ``lines`` structs, the cleaned text and the verdict.

    Adds one struct column ``quality`` (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_lines, n_failed_lines, kept_chars, cleaned, kept). A null or
    blank text has no words, fails the base rules, and its cleaned text is the text itself.
    Every row is judged by itself, so repeated rows and ties play no part; a column named
    ``quality`` of the input is replaced. One pass, no shuffle.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    parts = settled(docs, "quality", words_of(body).alias("words"), F.split(body, "\n", -1).alias("lines"))
    q = F.col("quality")
    measured = settled(
        parts,
        "quality",
        F.size(q["words"]).cast("long").alias("n_words"),
        F.length(F.array_join(q["words"], "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, rf"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        repeated_words(q["words"]).alias("n_repeat_words"),
        F.transform(
            q["lines"],
            lambda line: F.struct(
                line.alias("line"),
                line.rlike(r"[^\x20\x09-\x0D]").alias("has_word"),
                line_failure(line, rules).alias("broken"),
            ),
        ).alias("judged"),
    )
    worded = F.filter(q["judged"], lambda x: x["has_word"])
    passed = F.filter(q["judged"], lambda x: ~x["has_word"] | x["broken"].isNull())
    cleaned = settled(
        measured,
        "quality",
        *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_repeat_words")],
        (F.size(worded) - F.size(F.array_distinct(worded["line"]))).cast("long").alias("n_dup_lines"),
        F.size(worded).cast("long").alias("n_lines"),
        F.size(F.filter(worded, lambda x: x["broken"].isNotNull())).cast("long").alias("n_failed_lines"),
        F.array_join(passed["line"], "\n").alias("cleaned"),
        (
            (q["n_words"] < rules.least_words)
            | (100 * q["n_repeat_words"] > rules.most_repeat_percent * q["n_words"])
        ).alias("base_failed"),
    )
    left = settled(
        cleaned,
        "quality",
        *[
            q[c].alias(c)
            for c in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "n_lines", "n_failed_lines", "cleaned",
            )
        ],
        F.length(F.regexp_replace(q["cleaned"], WORD_GAP, "")).cast("long").alias("kept_chars"),
    )
    return left.withColumn(
        "quality",
        q.withField(
            "kept",
            ~q["base_failed"] & (q["kept_chars"] >= (1 - rules.most_lost) * q["word_chars"]),
        ),
    )


def clean(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """The kept documents, their text cleaned; columns as before, ``n_chars`` counted anew."""
    kept = judge(docs, rules, text).where("quality.kept")
    out = []
    for c in docs.columns:
        if c == text:
            out.append(F.col("quality.cleaned").alias(c))
        elif c == "n_chars":
            out.append(F.length("quality.cleaned").cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return kept.select(*out)
