"""The shared folder of the cluster, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names, made ready for ``checkpoint()``.

    Where the setting is missing, a local session (a test) gets a temporary folder;
    a cluster must name one, because its executors do not share a local disk.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="venuelens-"))
    return context.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    What follows does not compute ``df`` again, also when an executor is lost, and Spark
    knows the size of the files when it chooses a join.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/venuelens-tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
