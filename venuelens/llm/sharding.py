"""Weighted rendezvous hashing of record keys over shards, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.llm.tables import written

SHARDS = 8
# Slots are numbered within buckets of a shard: more buckets, more tasks.
BUCKETS = 1024
# Rows that one task unrolls from one counted group of equal rows.
UNROLLED = 100_000
SEED = 20240229


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: the one whose draw for the key is best.

    Each shard draws u in (0, 1) from a hash of key and shard number; the largest
    -weight / ln(u) wins, so a shard gets rows in proportion to its weight. A further shard
    leaves all other draws as they are: rows move only into it. A weight of zero takes no
    rows. A null key is a key like any other. Equal draws go to the lower shard.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            # 52 bits of the hash, in the middle of their step, so that 0 < u < 1.
            bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(SEED)), 12)
            u = (bits.cast("double") + 0.5) / float(1 << 52)
            draws.append(F.struct((F.lit(-float(weight)) / F.ln(u)).alias("draw"), F.lit(-shard).alias("s")))
    best = F.greatest(*draws) if len(draws) > 1 else draws[0]
    return (-best["s"]).cast("int")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def with_shard(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row, without a shuffle."""
    return docs.withColumn(column, shard_of(F.col(key), weights))


def placements(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, key: str = "doc_id", text: str = "text",
    new_weight: float = 1.0,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    Slots are gapless from 0 in each shard. Rows equal in id, size and crc are counted before
    the shuffle and unrolled after it, so a key that repeats without limit is spread. The other
    rows of a shard are numbered within hash buckets, whose starts come from their totals:
    no shard is ordered in one task. The totals have one row per shard and bucket, a fixed
    number. Null ids are a key of their own; null texts have size 1 and the crc of empty ones.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (text_bytes(F.col(text)) + 1).alias("size"),
        text_crc32(F.col(text)).alias("text_crc32"),
    )
    # The texts are read once, for three numbers each.
    counted = written(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")), "counted")
    placed = counted.select(
        "*",
        shard_of(F.col("doc_id"), weights).alias("shard"),
        shard_of(F.col("doc_id"), [*weights, new_weight]).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(BUCKETS)).alias("bucket"),
    )
    totals = placed.groupBy("shard", "bucket").agg(F.sum("n").alias("total"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    within = (
        Window.partitionBy("shard", "bucket")
        .orderBy("doc_id", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = placed.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
    # At most len(weights) * BUCKETS rows: bounded by parameters, not by the data.
    slotted = numbered.join(F.broadcast(starts), ["shard", "bucket"])
    single = slotted.withColumn("first", F.col("start") + F.col("first"))
    pieces = single.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(UNROLLED).cast("long"))).alias("from"))
    spread = pieces.where("n = 1").unionByName(pieces.where("n > 1").hint("rebalance"))
    last = F.least(F.col("from") + UNROLLED, F.col("n")) - 1
    return spread.select("*", F.explode(F.sequence("from", last)).alias("copy")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first") + F.col("copy")).alias("slot"), "grown_shard",
    )
