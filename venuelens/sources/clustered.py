"""The fact laid out for row filters: neighbours in city, locality and tier lie together in the files.

Every one of the three columns is cut into ranges, and rows lie in the order of a key that interleaves the
bits of the three range numbers, the highest bits first. A filter on any of them, not only on the one a plain sort
begins with, then meets a run of pages and passes over the others by their smallest and largest values.
Venue id and locality have Parquet bloom filters, for row groups that such values cannot rule out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.sources import star

# Ranges of a column, at most.
RANGES = {"city": 64, "locality": 64, "price_range": 8}
# Rows of a file, and of a page. The task that writes a file sorts its rows, some 600 bytes each in memory.
FILE_ROWS, PAGE_ROWS = 250_000, 20_000


def range_starts(fact: DataFrame, column: str, ranges: int) -> list:
    """The first values of all ranges but the lowest: ``ranges`` - 1 at most, whatever the data.

    Distinct values are dealt into ranges by Spark, and one value a range comes back. They say only where rows
    lie, so nothing depends on the sample the dealing takes.
    """
    values = fact.select(column).where(F.col(column).isNotNull()).distinct()
    dealt = values.repartitionByRange(ranges, column)
    first = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(column).alias("start"))
    return sorted(row.start for row in first.collect())[1:]


def range_number(value: Column, starts: Sequence) -> tuple[Column, int]:
    """The range a value lies in, found by halving the starts, and the bits it takes. Few ranges are spread evenly
    over the numbers of so many bits, so that the highest bit halves them. Nulls lie in the highest range."""
    bits = len(starts).bit_length()

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit((low << bits) // (len(starts) + 1))
        middle = (low + high) // 2
        return F.when(value < F.lit(starts[middle]), among(low, middle)).otherwise(among(middle + 1, high))

    return among(0, len(starts)), bits


def interleaved(numbers: Sequence[tuple[Column, int]]) -> Column:
    """One number from the bits of many, the highest bit of each first. A number comes with its bits."""
    key = F.lit(0)
    for level in range(max((bits for _, bits in numbers), default=0)):
        for number, bits in numbers:
            if level < bits:
                bit = F.shiftright(number, bits - 1 - level).bitwiseAND(F.lit(1))
                key = key * 2 + bit
    return key


def write_clustered(
    spark: SparkSession, path: str, page_rows: int = PAGE_ROWS, group_bytes: int = 128 << 20, least: int = 8
) -> DataFrame:
    """Write the fact of the star folder ``path`` once more, clustered, and read it.

    Files follow the size of the fact. The venue id ends the key that rows are dealt by, so a city, locality and
    tier that together hold most of the rows fill many files and not one task.
    """
    fact = star.read_fact(spark, path)
    files = max(least, -(-fact.count() // FILE_ROWS))
    numbers = [range_number(F.col(column), range_starts(fact, column, most)) for column, most in RANGES.items()]
    order = ["country", "cell", "venue_id"]
    dealt = fact.withColumn("cell", interleaved(numbers)).repartitionByRange(files, *order)
    options = {
        "parquet.block.size": group_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.bloom.filter.enabled#venue_id": "true",
        "parquet.bloom.filter.expected.ndv#venue_id": FILE_ROWS,
        "parquet.bloom.filter.enabled#locality": "true",
    }
    writer = dealt.sortWithinPartitions(*order).drop("cell").write.mode("overwrite").options(**options)
    writer.partitionBy("country").parquet(f"{path}/clustered/fact")
    return read_clustered(spark, path)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """The clustered fact that ``write_clustered`` wrote under the star folder ``path``."""
    return star.read_fact(spark, f"{path}/clustered")
