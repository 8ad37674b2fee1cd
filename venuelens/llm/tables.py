"""Reading the corpus tables, and tables written in the shared folder to cut lineage."""

from __future__ import annotations

import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.sources.shared import shared_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the corpus."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    What follows does not compute ``df`` again, also when an executor is lost, and Spark
    knows the size of the files when it chooses a join.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/venuelens-llm/{spark.sparkContext.applicationId}"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """At most ``rows`` rows, those with the lowest hashes of ``key``, of the ``total`` in ``df``.

    Hashes so high that they cannot be among them are left out first, so that what is ordered
    and sent does not grow with the number of partitions.
    """
    place = F.xxhash64(F.col(key), F.lit(41))
    if total > 2 * rows:
        df = df.where(place < -(1 << 63) + int(2 * rows / total * (1 << 64)))
    return df.orderBy(place, key).limit(rows)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for the rows of one fold by crc32 of the id as text. A null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))


def finite(vector: Column) -> Column:
    """True for vectors that are not null and hold no null, NaN or infinite component."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(good, F.lit(False))


def commonest_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors of a column have, the longer on a tie; 0 without rows."""
    counts = df.groupBy(F.size(vector).alias("length")).count()
    first = counts.orderBy(F.desc("count"), F.desc("length")).limit(1).first()
    return first["length"] if first else 0


def shared(spark: SparkSession, value: object) -> Broadcast[bytes]:
    """A broadcast of ``value`` with its class, for ``cloudpickle.loads``: executors need not have this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))
