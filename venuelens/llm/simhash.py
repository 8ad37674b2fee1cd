"""SimHash near-duplicates by one-wildcard segment signatures.

Fingerprints of 64 bits link at two or fewer differing bits. A fingerprint is cut into two
segments; of two linked fingerprints one segment differs by one bit at most. Each segment is
indexed under its 32 variants with one bit struck out, so that such a pair has a variant in
common: an equality join finds it, and counting the differing bits verifies it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.llm.components import components
from venuelens.llm.tables import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENT = 32
# Fingerprints under one variant that are joined pair by pair; a larger group is linked
# through shared neighbours instead, which finds the same links in linear work.
PAIRED = 64


def fingerprint(text: bytes | None) -> int:
    """SimHash of UTF-8 bytes as a signed long; null and blank texts give zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        found = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
        found = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans]
    lanes = np.array(found, "<u8").view(np.uint8).reshape(-1, 8)
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    ones = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ bits for i in range(8)])
    set_bits = sum(1 << i for i in np.flatnonzero(2 * ones > len(found)).tolist())
    return set_bits - (1 << 64) if set_bits >> 63 else set_bits


def fingerprints(text: Column) -> Column:
    """The fingerprint of a text column."""

    @F.pandas_udf("long")
    def computed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(x) for x in texts], dtype="int64")

    return computed(text.cast("binary"))


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint under the 64 variants of its two segments.

    The key holds the struck bit's place above the segment without that bit.
    """
    place = F.explode(F.sequence(F.lit(0), F.lit(2 * SEGMENT - 1))).alias("place")
    half = f"(shiftrightunsigned(fp, cast(place div {SEGMENT} * {SEGMENT} as int)) & 4294967295)"
    struck = f"(~shiftleft(1L, cast(place % {SEGMENT} as int)))"
    key = F.expr(f"shiftleft(cast(place as bigint), 32) | ({half} & {struck})").alias("key")
    return fps.select("fp", place).select(key, "fp")


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links that connect what two or fewer differing bits connect, from distinct ``fp``.

    Every linked pair of a variant group of up to ``PAIRED`` fingerprints is returned. Larger
    groups are connected through neighbours, of which a key has at most 65.
    """
    # One shuffle: counting first and joining back would deal all variants twice. Of a very common variant, one
    # task counts the different fingerprints; it sorts and spills, and keeps none of them in memory.
    group = Window.partitionBy("key")
    shared = variants(fps).withColumn("n", F.count("*").over(group)).where("n > 1")
    shared = written(shared, "variants")
    few = shared.where(F.col("n") <= PAIRED)
    left = few.select("key", F.col("fp").alias("a"))
    right = few.select("key", F.col("fp").alias("b"))
    # A pair whose segments are equal meets in all 32 variants: it counts in the first.
    place = F.shiftrightunsigned("key", 32)
    segment = F.expr(
        f"shiftrightunsigned(a ^ b, cast(shiftrightunsigned(key, 32) div {SEGMENT} * {SEGMENT} as int))"
        " & 4294967295"
    )
    pairs = (
        left.join(right, "key")
        .where(F.col("a") < F.col("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
        .where((segment != 0) | (place % SEGMENT == 0))
        .select("a", "b")
    )
    many = shared.where(F.col("n") > PAIRED).select("fp").distinct()
    return pairs.unionByName(through_neighbours(many))


def through_neighbours(fps: DataFrame) -> DataFrame:
    """Links of fingerprints two or fewer bits apart, through what is one bit or less from both.

    Two fingerprints are that near exactly if they have such a neighbour in common, and each
    neighbour ties all fingerprints around it to the smallest of them.
    """
    near = F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))")
    spread = fps.select("fp", F.explode(F.concat(F.array("fp"), near)).alias("neighbour"))
    spread = written(spread, "neighbours")
    least = spread.groupBy("neighbour").agg(F.min("fp").alias("b"))
    tied = spread.join(least, "neighbour").select(F.col("fp").alias("a"), "b")
    return tied.where("a != b").distinct()


def groups(fps: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint that links reach from each of the distinct ``fp``."""
    joined = written(components(links(fps)), "components")
    rooted = fps.join(joined, fps.fp == joined.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return written(rooted, "rooted")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest id reachable through links. Equal fingerprints are one node,
    so copies cost one row each and no pairs. Null and blank texts have fingerprint zero.
    Rows without an id take part and get their group's id, null if no row of it has one;
    repeated rows are returned as often as they occur.
    """
    marked = docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text)).alias("fp"))
    marked = written(marked, "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    rooted = nodes.join(groups(nodes.select("fp")), "fp")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    labels = written(rooted.join(named, "root").select("fp", "component_id"), "labels")
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` of each group that links connect, all columns as they are.

    It is the row with the smallest id, of these the one with the lowest hash of its text; rows without an
    id come last. Null and blank texts are one group; very long texts count whole. Rows repeated with the
    same id and text stay once.
    """
    digest = F.xxhash64(F.col(text))
    marked = docs.select(F.col(doc_id).alias("id"), digest.alias("hash"), fingerprints(F.col(text)).alias("fp"))
    marked = written(marked, "fingerprints")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "hash")
    firsts = written(marked.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    standing = firsts.join(groups(firsts.select("fp")), "fp").groupBy("root").agg(F.min("first").alias("first"))
    standing = written(standing.select("first.id", "first.hash"), "standing")
    same = F.col("m.id").eqNullSafe(F.col("s.id")) & (F.col("m.hash") == F.col("s.hash"))
    rows = marked.alias("m").join(standing.alias("s"), same, "left_semi").groupBy("id", "hash").count()
    rows = written(rows, "standing-rows")
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("id"), digest.alias("hash")).alias("m")
    one = named.join(rows.where("count = 1").alias("s"), same, "left_semi")
    repeated = named.join(rows.where("count > 1").alias("s"), same, "left_semi").dropDuplicates(["id", "hash"])
    return one.unionByName(repeated).select("row.*")
