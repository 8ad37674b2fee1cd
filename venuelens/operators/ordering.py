"""Exact order statistics without sorting a dataset in one task.

``percentile`` keeps every distinct value of a group in one buffer and a window
without a partition sends everything to one task. Both are avoided in steps: values
go into buckets of equal relative width, buckets that hold many values are split
evenly between their own smallest and largest value, and only then are values
ordered, inside their own piece. Pieces follow from exact counts and extremes, not from a sample,
so every evaluation of a plan, also after a lost executor, finds the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from venuelens.sources.shared import written

# Distinct values that one task orders, and ranges they are dealt into at most; a range of
# very many values is larger, so that the table of ranges stays bounded.
PIECE = 65_536
MOST_PIECES = 20_000
# Buckets per factor e: about 0.4 % relative width. Doubles span about 1,456 such
# factors to each side of zero, so there are never more than about 746,000 buckets.
STEPS = 256
# The logarithm of the smallest double is just above minus this.
LOWEST_LOG = 746
# A bucket of more values than this is split.
SPLIT_ABOVE = 4_096


def bucket_of(value: Column) -> Column:
    """A bucket number that never decreases as the value grows; 0 has its own."""
    size = F.floor((F.ln(F.abs(value)) + LOWEST_LOG) * STEPS) + 1
    return F.coalesce(F.signum(value) * size, F.lit(0)).cast("long")


def _pieces(rows: Column) -> Column:
    """Into how many pieces to split a bucket of ``rows`` rows."""
    return F.when(rows > SPLIT_ABOVE, F.ceil(rows * 2.0 / SPLIT_ABOVE)).otherwise(F.lit(1)).cast("long")


def _piece_of(value: Column) -> Column:
    """The piece of a value between ``_lo`` and ``_hi``, never decreasing as it grows."""
    low, high = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    place = F.floor(F.try_divide(value.cast("double") - low, high - low) * F.col("_pieces"))
    split = (F.col("_pieces") > 1) & (high > low)
    return F.when(split, F.least(place, F.col("_pieces") - 1)).otherwise(F.lit(0)).cast("long")


def ranged(values: DataFrame, order: Sequence[str], piece: int | None = None) -> DataFrame:
    """Written rows in ranges of ``order``, numbered in ``_piece``, none of more than ``piece`` rows.

    Rows must be distinct in ``order``. The boundaries are sampled, so the rows of each written range are
    counted: while one is too large, all are dealt again into twice as many ranges.
    """
    seen = Observation()
    values = written(values.observe(seen, F.count(F.lit(1)).alias("rows")), "distinct")
    rows = seen.get["rows"]
    limit = max(piece or PIECE, -(-4 * rows // MOST_PIECES))
    if rows <= limit:
        return values.withColumn("_piece", F.lit(0))
    pieces = -(-4 * rows // limit)
    while True:
        dealt = values.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id())
        dealt = written(dealt, "ranges")
        if dealt.groupBy("_piece").count().agg(F.max("count")).first()[0] <= limit:
            return dealt
        pieces *= 2


def totals_below(values: DataFrame, value: str, weight: str, series: Sequence[str] = ()) -> DataFrame:
    """Add ``below``: the weight of all smaller values of the same series. One row per distinct value."""
    series = list(series)
    placed = ranged(values, [*series, value])
    earlier = Window.partitionBy(*series).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*series, "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*series, "_piece")
        .agg(F.sum(weight).alias("_filled"))
        .select(*series, "_piece", F.coalesce(F.sum("_filled").over(earlier), F.lit(0)).alias("_start"))
    )
    below = F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    # One row per range and series, of which there is a bounded number whatever the data.
    return placed.join(F.broadcast(starts), [*series, "_piece"]).withColumn("below", below).drop("_piece", "_start")


def numbered(df: DataFrame, columns: Mapping[str, Column], weight: Column) -> DataFrame:
    """(series, value, n, below) of the distinct known values of several columns, in the same passes.

    ``weight`` says how many rows a row stands for; n is its sum, and below that of all smaller values.
    """
    each = [F.struct(F.lit(name).alias("series"), c.cast("double").alias("value")) for name, c in columns.items()]
    long = df.select(F.inline(F.array(*each)), weight.alias("n")).where(F.col("value").isNotNull())
    counted = long.groupBy("series", "value").agg(F.sum("n").alias("n"))
    return totals_below(counted, "value", "n", ["series"])


def average_rank() -> Column:
    """1-based rank of a numbered value, ties sharing the mean of their places."""
    return F.col("below") + (F.col("n") + 1) / 2


def average_ranks(df: DataFrame, column: str, weight: str) -> DataFrame:
    """1-based rank of each distinct value, ties sharing the mean of their places.

    ``weight`` says how many rows a row stands for.
    """
    found = numbered(df, {column: F.col(column)}, F.col(weight))
    return found.select(F.col("value").alias(column), average_rank().alias("rank"))


def dense_ranks(df: DataFrame, *columns: str) -> DataFrame:
    """(series, value, rank): 1-based dense rank of each distinct value of ``columns``, largest first."""
    distinct = [F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(F.inline(F.array(*distinct))).where(F.col("value").isNotNull()).distinct()
    long = long.select("series", "value", (-F.col("value")).alias("_down"), F.lit(1).alias("_one"))
    found = totals_below(long, "_down", "_one", ["series"])
    return found.select("series", "value", (F.col("below") + 1).cast("long").alias("rank"))


def ranks_in(ranks: DataFrame, series: str, column: str, rank: str) -> DataFrame:
    """One series of a rank table, to join by ``column``."""
    return ranks.where(F.col("series") == series).select(F.col("value").alias(column), F.col("rank").alias(rank))


def _interpolated(probabilities: Mapping[str, float]) -> list[Column]:
    """Aggregates of numbered values with their ``_total``: a value holds the positions from ``below`` to ``below`` + n."""

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("below") + F.col("n") > place, F.col("value")))

    def quantile(p: float) -> Column:
        position = (F.col("_total") - 1) * F.lit(float(p))
        low, high = at(F.floor(position)), at(F.ceil(position))
        return low + F.max(position - F.floor(position)) * (high - low)

    return [quantile(p).alias(name) for name, p in probabilities.items()]


def quantiles_by(ordered: DataFrame, key: str, probabilities: Mapping[str, float]) -> DataFrame:
    """Quantiles with linear interpolation of ``numbered`` values, a row for each ``key``, in one aggregate.

    What a position needs of the key's total comes with a join of one row for each key.
    """
    totals = ordered.groupBy(F.col(key).alias("_key")).agg(F.sum("n").alias("_total"))
    return ordered.join(totals, F.col(key) == F.col("_key")).groupBy(key).agg(*_interpolated(probabilities))


def quantiles_of(ordered: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """Quantiles of a single series as one row, of nulls when there are no values."""
    total = ordered.agg(F.sum("n").alias("n")).scalar()
    return ordered.withColumn("_total", total).agg(*_interpolated(probabilities))


def quantiles(
    df: DataFrame, value: str, probabilities: Mapping[str, float], keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per named probability.

    ``weight`` names the number of times that a row's value counts; without it, once.

    The first pass counts values per bucket. The second reads only the buckets that hold
    a wanted position and counts them in pieces, and the last orders only the pieces that
    hold one, so what is shuffled by value is a sliver of the data. Without
    keys the result is one row, of nulls when there are no values.
    """
    keys = list(keys)
    points = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_value"), (F.col(weight) if weight else F.lit(1)).alias("_w")
    )
    for key in keys:
        points = points.where(F.col(key).isNotNull())

    def position(p: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(p))

    def holds(place: Column) -> Column:
        return (F.col("_start") <= place) & (place < F.col("_start") + F.col("_filled"))

    wanted = F.lit(False)
    for p in probabilities.values():
        wanted = wanted | holds(F.floor(position(p))) | holds(F.ceil(position(p)))

    def holding(rows: DataFrame, outer: list[str], level: str) -> DataFrame:
        """The buckets of ``level`` that hold a wanted position, with the rows before them."""
        counted = rows.groupBy(*outer, level).agg(
            F.sum("_w").alias("_filled"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi"),
            *[F.min(c).alias(c) for c in ("_start", "_total") if c in rows.columns],
        )
        within = Window.partitionBy(*outer)
        earlier = within.orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_filled").over(earlier), F.lit(0))
        if "_start" in rows.columns:
            counted = counted.withColumn("_start", F.col("_start") + before)
        else:
            counted = counted.withColumns({"_start": before, "_total": F.sum("_filled").over(within)})
        found = counted.where(wanted).withColumn("_pieces", F.least(_pieces(F.col("_filled")), F.lit(65_536)))
        # Two buckets per probability and key at most: without keys that is a bound, with
        # keys the join is left to Spark.
        found = found.drop("_filled")
        return found if keys else F.broadcast(found)

    bucketed = points.withColumn("_level0", bucket_of(F.col("_value")))
    chosen = holding(bucketed, keys, "_level0")
    split = bucketed.join(chosen, [*keys, "_level0"]).withColumn("_level1", _piece_of(F.col("_value")))
    levels = [*keys, "_level0"]
    finer = holding(split, levels, "_level1").drop("_lo", "_hi", "_pieces")
    levels.append("_level1")

    inside = Window.partitionBy(*levels).orderBy("_value")
    ranked = (
        split.select(*levels, "_value", "_w")
        .join(finer, levels)
        .groupBy(*levels, "_start", "_total", "_value")
        .agg(F.sum("_w").alias("_n"))
        .withColumn("_through", F.col("_start") + F.sum("_n").over(inside))
    )

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("_through") > place, F.col("_value")))

    ends = []
    for name, p in probabilities.items():
        ends.append(at(F.floor(position(p))).alias(f"_low_{name}"))
        ends.append(at(F.ceil(position(p))).alias(f"_high_{name}"))
    summary = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *ends)

    def between(name: str, p: float) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return low + (position(p) - F.floor(position(p))) * (high - low)

    return summary.select(*keys, *[between(n, p).alias(n) for n, p in probabilities.items()])
