"""Session settings the engine is meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Adaptive execution splits hot join keys and sizes partitions at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files of dictionaries are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call sites of every column expression are not recorded: half the planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(name: str = "venuelens") -> SparkSession.Builder:
    """A session builder with the settings above. Cluster settings (master, memory,
    ``spark.checkpoint.dir``, shuffle partitions) stay with the caller."""
    made = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made
