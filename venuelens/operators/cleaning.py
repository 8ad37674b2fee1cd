"""Raw rows to fact rows.

Apart from de-duplication and the country lookup every rule is a projection, so
the whole cleaning pass is one scan, one shuffle on the venue key and one write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.config import CleaningRules
from venuelens.functions import columns as C
from venuelens.functions.statistics import total
from venuelens.schemas import AUDITED, FLAG_COLUMNS


def normalise_names(df: DataFrame) -> DataFrame:
    """Strip white space around column names."""
    return df.toDF(*[name.strip() for name in df.columns])


def trim_text(df: DataFrame) -> DataFrame:
    """Strip white space in every text column, chosen by schema."""
    text = {
        f.name: C.trimmed(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(text) if text else df


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    ``row_number() = 1`` plans as a partial group limit before the shuffle, so a
    key that holds a large part of the rows sends one row per task, not all.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(first)).where("_position = 1").drop("_position")


def keep_first_counted(
    df: DataFrame, key: str, order: Sequence[str], copies: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """``keep_first`` by ascending columns, with the number of rows each key had. Of the row, ``columns`` are
    kept (all, if none are named).

    One aggregate: its partial result per task is one row and a count for every key,
    however often the key occurs.
    """
    row = F.struct(*[F.col(name) for name in columns or df.columns])
    grouped = df.groupBy(F.col(key).alias("_key")).agg(
        F.min_by(row, F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias(copies)
    )
    return grouped.select("_first.*", copies)


def attach_country(df: DataFrame, countries: DataFrame, unknown: str) -> DataFrame:
    """Add ``country`` from (country_code, country); codes without a name get ``unknown``."""
    named = df.drop("country").join(countries.select("country_code", "country"), "country_code", "left")
    return named.withColumn("country", F.coalesce("country", F.lit(unknown)))


def cast_flags(df: DataFrame, flags: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    return df.withColumns({name: C.yes_no(F.col(name)) for name in flags if name in df.columns})


def constant_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates with at most one distinct non-null value.

    Minimum equals maximum says the same as a distinct count of one, without
    shuffling the values. One row comes back to the driver.
    """
    present = [name for name in candidates if name in df.columns]
    if not present:
        return []
    checks = [
        F.coalesce(F.min(name) == F.max(name), F.lit(True)).alias(name) for name in present
    ]
    verdict = df.agg(*checks).first()
    return [name for name in present if verdict[name]]


def drop_constants(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    return df.drop(*constant_columns(df, candidates))


def null_sentinels(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Zeros that mean "unknown" become null, with the flags that record it."""
    rating = C.null_if_nan(F.col("rating"))
    cost = C.null_if_nan(F.col("cost"))
    is_rated = F.coalesce(rating > 0, F.lit(False))
    return df.withColumns(
        {
            "is_rated": is_rated,
            "rating": F.nullif(rating, F.lit(0.0)),
            "rating_text": F.when(is_rated, F.col("rating_text")).otherwise(F.lit(rules.not_rated)),
            "cost": F.when(cost > 0, cost),
        }
    )


def parse_cuisines(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Name the missing list, count its items, and keep the distinct ones as an array."""
    filled = df.withColumn("cuisines", F.coalesce("cuisines", F.lit(rules.unspecified_cuisine)))
    items = C.tokens(F.col("cuisines"))
    return filled.withColumns(
        {"cuisine_count": F.size(items), "cuisine_list": F.array_distinct(items)}
    )


def derive(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Analytical columns; the money ones exist only in the home currency."""
    home_money = F.coalesce(
        F.col("currency").contains(rules.scope.home_currency), F.lit(False)
    )
    rating, cost, votes = F.col("rating"), F.col("cost"), F.col("votes")
    return df.withColumns(
        {
            "price_label": C.lookup(F.col("price_range"), rules.price_labels),
            "has_votes": F.coalesce(votes > 0, F.lit(False)),
            "cost_band": F.when(home_money, C.band(cost, rules.cost_bands)),
            "value_score": F.when(
                home_money & F.col("is_rated") & (cost > 0), C.value_per_hundred(rating, cost)
            ),
            "credible": F.col("is_rated") & F.coalesce(votes >= rules.floors.votes, F.lit(False)),
            "geo_valid": C.geo_valid(F.col("latitude"), F.col("longitude")),
        }
    )


def audit(df: DataFrame) -> DataFrame:
    """Remember, per row, what the next rules erase; the quality log counts it."""
    return df.withColumns(
        {
            "rating_was_zero": F.coalesce(F.col("rating") == 0, F.lit(False)),
            "cost_was_void": F.coalesce(F.col("cost") <= 0, F.lit(False)),
        }
    )


def as_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, in its order and types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def clean_rows(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Every row-level rule, on trimmed, de-duplicated rows that have their country:
    the fact columns followed by the audit columns."""
    typed = audit(cast_flags(df))
    return as_table(derive(parse_cuisines(null_sentinels(typed, rules), rules), rules), AUDITED)


def bridge(fact: DataFrame) -> DataFrame:
    """Distinct (venue, cuisine) pairs.

    The array is already distinct and the fact holds a venue once, so the explode
    is the whole job and nothing is shuffled.
    """
    return fact.select("venue_id", F.explode("cuisine_list").alias("cuisine"))


def quality_log(audited: DataFrame, rules: CleaningRules, raw_columns: int) -> DataFrame:
    """What cleaning changed, one row per step, from one aggregate over the audited rows."""
    flags = [name for name in rules.constant_candidates if name in audited.columns]
    constant = {name: F.coalesce(F.min(name) == F.max(name), F.lit(True)) for name in flags}
    counts = audited.agg(
        total(F.col("copies")).alias("loaded"),
        F.count(F.lit(1)).alias("kept"),
        F.count_if(F.col("country") == rules.unknown_country).alias("unmapped"),
        F.count_if("rating_was_zero").alias("unrated"),
        F.count_if("cost_was_void").alias("no_cost"),
        F.count_if(F.col("cuisines") == rules.unspecified_cuisine).alias("no_cuisine"),
        total(F.size("cuisine_list")).alias("pairs"),
        F.count_if(~F.col("geo_valid")).alias("bad_geo"),
        *[check.alias(f"constant_{name}") for name, check in constant.items()],
    )

    def step(name, rows, detail, when=F.lit(True)):
        return F.struct(
            F.lit(name).alias("step"),
            rows.cast("long").alias("rows_affected"),
            F.lit(detail).alias("detail"),
            when.alias("logged"),
        )

    steps = [
        step("load", F.col("loaded"), f"rows read, {raw_columns} columns"),
        step("dedupe", F.col("loaded") - F.col("kept"), "repeated venue ids dropped"),
        step(
            "country_map",
            F.col("unmapped"),
            f"country codes without a name, set to {rules.unknown_country}",
            F.col("unmapped") > 0,
        ),
        *[
            step("drop_constant", F.col("kept"), f"{name} never varies, dropped", F.col(f"constant_{name}"))
            for name in flags
        ],
        step("rating_zero_to_null", F.col("unrated"), "rating 0 means not rated"),
        step("cost_zero_to_null", F.col("no_cost"), "cost of 0 or less means unknown"),
        step(
            "cuisine_missing",
            F.col("no_cuisine"),
            f"no cuisines, set to {rules.unspecified_cuisine}",
            F.col("no_cuisine") > 0,
        ),
        step("cuisine_explode", F.col("pairs"), "venue-cuisine pairs"),
        step("derived", F.col("kept"), f"cost band, value score, credible at {rules.floors.votes} votes"),
        step("geo_flag", F.col("bad_geo"), "coordinates flagged invalid"),
    ]
    return (
        counts.select(F.inline(F.array(*steps)))
        .where("logged")
        .select("step", "rows_affected", "detail")
    )
