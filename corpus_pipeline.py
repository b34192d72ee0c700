"""From raw documents to packed training sequences, one operator per stage.

Every stage takes any documents: null, empty and very long texts, null and repeated ids, further columns
of any name, no rows at all. A null or empty text fails the quality rules; given to a later stage it
has no shingle, no benchmark word and no entity, stays as it is, and is packed as its closing id. A null id
stays null; near-dedup ranks it behind all others. Rows alike in id and text count as one document in near-dedup, whose
representative is the least id; rows that share only the id are documents of their own. All but the
last stage return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backframe.llm.common import table
from backframe.llm.decontaminate import decontaminate
from backframe.llm.packing import pack
from backframe.llm.pii import replace_entities
from backframe.llm.quality import clean
from backframe.llm.simhash import one_of_each
from backframe.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that broke a rule."""
    return clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where("NOT hits.contaminated").select(docs.columns)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced, ``n_chars`` counted anew."""
    out = replace_entities(docs).select(docs.columns)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the sequences."""
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("packing", packing),
]

#: Fingerprints and token ids are beyond SQL; a test holds run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
