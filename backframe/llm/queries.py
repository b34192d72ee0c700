"""The named query of each operator, over its whole table, and the SQL that checks it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backframe.llm import chat
from backframe.llm.common import table
from backframe.llm.decontaminate import decontaminate
from backframe.llm.ngram_lm import score_documents
from backframe.llm.packing import pack
from backframe.llm.phrases import collocations
from backframe.llm.pii import replace_entities
from backframe.llm.quality import judge
from backframe.llm.runs import periodic_runs, with_planted_runs
from backframe.llm.sharding import shard_documents
from backframe.llm.simhash import near_duplicates
from backframe.llm.substrings import substring_dedup
from backframe.llm.suffixes import suffix_dedup
from backframe.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SHARDS = 40


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    more = ("n_lines", "n_failed_lines", "kept_chars")
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *[f"quality.{c}" for c in (*base, *more)])


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "hits.*")


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def chat_digest(turns: list[tuple[str, str]], loss: str, shown: str) -> tuple:
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    told = "".join(f"{role}\n{text}\n" for role, text in turns)
    return len(turns), sha(told), len(loss), sha(loss), len(shown)


@query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.texts_read_back(
        chat.format_chats(rows.unionByName(own)),
        chat_digest,
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def digests(found: DataFrame, units: str) -> DataFrame:
    return found.select(
        "doc_id",
        F.col("n_units").alias(units),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(suffix_dedup(table(spark, sf_dir, "documents")), "n_bytes")


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).select("doc_id", "tokens.*")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(substring_dedup(table(spark, sf_dir, "documents")), "n_words").drop("n_spans")


@query
def op11_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents")).select("doc_id", "lm.*")


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic_runs(docs).select("doc_id", "periodic.*")
    runs = F.col("runs")
    told = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(told, lambda r: F.concat(r, F.lit("\n"))), "")
    order = lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))
    best = F.array_max(F.transform(runs, order))["run"]
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
