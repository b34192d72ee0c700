"""Jump consistent hashing: shards from keys alone, with slots inside each shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backframe.llm.common import settled

#: Fixed value: multiplier of the 64-bit congruential generator that the method names.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF
#: Rows of one shard that one task numbers.
SLOT_ROWS = 500_000


def next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2^64, on halves, as SQL longs must not overflow."""
    c = [(MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]
    first = low * c[0] + 1
    second = low * c[1] + F.shiftright(first, 16)
    new_low = F.shiftleft(second.bitwiseAND(0xFFFF), 16).bitwiseOR(first.bitwiseAND(0xFFFF))
    upper = lambda x, a, b: x * a + F.shiftleft((x * b).bitwiseAND(0xFFFF), 16)
    new_high = F.shiftright(second, 16) + upper(high, c[0], c[1]) + upper(low, c[2], c[3])
    return new_high.bitwiseAND(LOW), new_low


def jump(key: Column, shards: int) -> Column:
    """Struct (shard, grown_shard, mixed) of a long key.

    ``grown_shard`` is the shard with one more; ``mixed`` are 31 bits of the first state, a
    hash of the key. A key leaves its shard for the n-th with probability 1/n, so it jumps about
    ln(shards) times; at most ``shards`` times, which bounds the loop for few shards, and for
    many the loop fails rather than stop early.
    """
    steps = min(shards, 64 + 8 * shards.bit_length())

    def step(a: Column) -> Column:
        high, low = next_state(a["high"], a["low"])
        drawn = F.shiftright(high, 1)
        return F.struct(
            high.alias("high"),
            low.alias("low"),
            a["next"].alias("shard"),
            F.floor((a["next"] + 1) * (F.lit(float(1 << 31)) / (drawn + 1))).alias("next"),
            F.coalesce(a["mixed"], drawn).alias("mixed"),
        )

    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(LOW).alias("low"),
        F.lit(-1).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("next"),
        F.lit(None).cast("long").alias("mixed"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        start,
        lambda a, _: F.when(a["next"] < shards, step(a)).otherwise(a),
        lambda a: F.struct(
            F.when(a["next"] < shards, F.raise_error(F.lit("too many jumps")).cast("int"))
            .otherwise(a["shard"].cast("int"))
            .alias("shard"),
            F.when(a["next"] == shards, F.lit(shards)).otherwise(a["shard"].cast("int")).alias("grown_shard"),
            a["mixed"].alias("mixed"),
        ),
    )


def shard_documents(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every document.

    A null key counts as 0; a null text is empty. Rows that repeat key and text lie side by side
    in their shard; other columns are left out, so their names cannot clash. Slots follow
    (chunk, key, size, crc); chunks are cut by the hash of the key, as many as keep one task to
    about ``slot_rows`` rows, so no task holds a shard. The first pass, for the sizes of the
    chunks, reads the keys alone.
    """
    rows = docs.count()
    chunks = max(1, -(-rows // (shards * slot_rows)))
    own = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = jump(F.coalesce(F.col(key).cast("long"), F.lit(0)), shards)
    dealt = settled(own, "j", placed.alias("placed")).select(
        key,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("j.placed.shard").alias("shard"),
        F.col("j.placed.grown_shard").alias("grown_shard"),
        F.pmod("j.placed.mixed", F.lit(chunks)).alias("chunk"),
    )
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        dealt.groupBy("shard", "chunk")
        .agg(F.count("*").alias("rows"))
        .select("shard", "chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("shard", "chunk").orderBy(F.col(key), "size", "text_crc32")
    numbered = dealt.withColumn("number", F.row_number().over(inside).cast("long") - 1)
    return numbered.join(firsts, ["shard", "chunk"]).select(
        key,
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("first") + F.col("number")).alias("slot"),
        "grown_shard",
    )
