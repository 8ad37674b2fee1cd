"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet and reads again as the next one's documents. A table without rows runs through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm import decontaminate, mixture, queries, sharding, simhash, toxicity
from venuelens.llm.tables import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# One epoch, so that no document is repeated, and most of what is left.
MIX = mixture.Mix(queries.LEVELS, queries.WEIGHTS, share=0.8, epochs=1)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half, learned from the labels of the folds to learn from."""
    return toxicity.keep_clean(docs, queries.toxicity_model(spark, sf_dir, docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints lie two or fewer bits apart."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken to meet the target weights of domains, languages and sources."""
    levels = {"domain": mixture.domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return mixture.keep_mixed(docs, MIX, levels)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their size and shard."""
    own = [F.col(c) for c in docs.columns if c not in ("size", "shard")]
    size = sharding.text_bytes(F.col("text")) + 1
    shard = sharding.shard_of(F.col("doc_id"), (1.0,) * sharding.SHARDS)
    return docs.select(*own, size.alias("size"), shard.alias("shard"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_copies),
    ("benchmark_decontamination", without_benchmark),
    ("mixture", to_weights),
    ("sharding", to_shards),
]

# Learning and edit distances have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
