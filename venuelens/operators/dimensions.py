"""Dimensions of the star, and dictionary codes for their values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.sources.shared import shared_folder


def literal_frame(spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence]) -> DataFrame:
    """A few fixed rows as a relation of literals, with no data sent from the driver."""
    records = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, row)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*records)))


def code_table(spark: SparkSession, mapping: Mapping[int, str], code: str, name: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField(code, T.IntegerType()), T.StructField(name, T.StringType())]
    )
    return literal_frame(spark, schema, list(mapping.items()))


def dim_country(fact: DataFrame) -> DataFrame:
    """Venues per country, code and currency; a missing key is a group of its own."""
    return (
        fact.groupBy("country_code", "country", "currency")
        .agg(F.count(F.lit(1)).alias("venues"))
        .orderBy(F.desc("venues"), "country_code", "currency")
    )


def dim_price_range(spark: SparkSession, labels: Mapping[int, str]) -> DataFrame:
    return code_table(spark, labels, "price_range", "price_label")


def dim_cuisine(bridge: DataFrame) -> DataFrame:
    return bridge.select("cuisine").distinct().orderBy("cuisine")


def dim_city(fact: DataFrame) -> DataFrame:
    return fact.select("city", "country").distinct()


def _listed_values(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every non-null value of the columns as a row (field, value), from one scan of them."""
    pairs = [F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in columns]
    return values.select(F.inline(F.array(*pairs))).where("value IS NOT NULL")


def dictionaries(sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One long dictionary (field, value, code) of all text columns of all sources: the 0-based code of
    each distinct non-null value of a field, in sort order. Field names are unique over the sources.

    All fields share one distinct, one range sort and one checkpoint. A sorted dataset is
    already numbered inside each partition, so a code is what earlier partitions hold of the field plus
    the row's place among the field's rows in its own. The sorted values are checkpointed: the range
    boundaries come from a sample, and a recomputed partition must not move rows between
    the two readings.
    """
    names = [name for _, columns in sources for name in columns]
    if not names or len(set(names)) < len(names):
        raise ValueError(f"one dictionary for each field, not {names}")
    shared_folder(sources[0][0].sparkSession)
    rows = reduce(DataFrame.unionByName, [_listed_values(df, columns) for df, columns in sources])
    placed = (
        rows.distinct()
        .orderBy("field", "value")
        .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
        .checkpoint()
    )
    sizes = placed.groupBy("field", "_part").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first")
    )
    # One row per shuffle partition, and one more per field that starts inside it: small by construction.
    earlier = Window.partitionBy("field").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    code = F.col("_start") + F.col("_place") - F.col("_first")
    return placed.join(F.broadcast(starts), ["field", "_part"]).select("field", "value", code.cast("long").alias("code"))


def dictionary_of(codes: DataFrame, field: str) -> DataFrame:
    """The dictionary of one field, as (field's name, code)."""
    return codes.where(F.col("field") == field).select(F.col("value").alias(field), "code")


def dictionary_codes(values: DataFrame, column: str) -> DataFrame:
    """0-based code of each distinct non-null value of one column, in sort order."""
    return dictionary_of(dictionaries([(values, [column])]), column)


def encode(df: DataFrame, column: str, codes: DataFrame, output: str) -> DataFrame:
    """Replace a value by its code; a value without one gets -1. Spark broadcasts the
    dictionary if it is small enough."""
    renamed = codes.select(F.col(column), F.col("code").alias(output))
    return df.join(renamed, column, "left").withColumn(output, F.coalesce(output, F.lit(-1).cast("long")))


def encode_list(df: DataFrame, key: str, items: str, codes: DataFrame, output: str) -> DataFrame:
    """Replace an array of values by the sorted array of their codes.

    Items are joined to the dictionary one by one, and the lists are put together again
    by key, which is unique; a list is as long as the row's own array, so it is safe to
    collect. Unknown and null items become -1; a null list is an empty one.
    """
    value = codes.columns[0]
    exploded = df.select(key, F.explode(items).alias(value))
    lists = (
        encode(exploded, value, codes, "_code")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("_code")).alias(output))
    )
    empty = F.array().cast("array<bigint>")
    return df.join(lists, key, "left").withColumn(output, F.coalesce(output, empty))
