"""Filter context: one predicate per selection, and the frames that follow from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.config import FilterSpec


def in_country(df: DataFrame, country: str) -> DataFrame:
    return df.where(F.col("country") == country)


def serves_any(cuisines: Sequence[str]) -> Column:
    """Includes at least one of the cuisines: a row test, so no join and no fan-out."""
    return F.arrays_overlap("cuisine_list", F.array(*[F.lit(c) for c in cuisines]))


def predicate(spec: FilterSpec) -> Column:
    """The whole filter context as one conjunction, which the Parquet scan can use.

    A test on a missing value is null, which neither ``where`` nor ``count_if`` passes.
    """
    tests: list[Column] = []
    if spec.cities:
        tests.append(F.col("city").isin(list(spec.cities)))
    if spec.cuisines:
        tests.append(serves_any(spec.cuisines))
    if spec.price_tiers:
        tests.append(F.col("price_range").isin(list(spec.price_tiers)))
    if spec.delivery_only:
        tests.append(F.col("has_delivery"))
    if spec.booking_only:
        tests.append(F.col("has_booking"))
    if spec.rated_only:
        tests.append(F.col("is_rated"))
    if spec.credible_only:
        tests.append(F.col("credible"))
    if spec.min_rating > 0:
        tests.append(F.col("rating") >= spec.min_rating)
    needle = spec.search.strip().lower()
    if needle:
        tests.append(
            F.lower("venue_name").contains(needle) | F.lower("locality").contains(needle)
        )
    return reduce(and_, tests, F.lit(True))


def apply_filters(fact: DataFrame, spec: FilterSpec) -> DataFrame:
    """Rows in the filter context; an empty spec keeps all, an impossible one none."""
    return fact.where(predicate(spec))


def serving(fact: DataFrame, bridge: DataFrame, cuisines: Sequence[str]) -> DataFrame:
    """The "includes" filter through a separate bridge table, as a semi join."""
    hits = bridge.where(F.col("cuisine").isin(list(cuisines)))
    return fact.join(hits, "venue_id", "left_semi")


def restrict_bridge(bridge: DataFrame, fact: DataFrame) -> DataFrame:
    """Pairs of the venues that survived a filter."""
    return bridge.join(fact.select("venue_id"), "venue_id", "left_semi")


def keys_of(dimension: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """The distinct keys of a dimension for a semi join, broadcast if there are at most
    ``most``: the count reads the dimension alone and stops one row beyond that. A larger
    dimension is left to a shuffle join."""
    keys = dimension.select(key).distinct()
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


def through_dimensions(
    fact: DataFrame,
    bridge: DataFrame,
    *,
    countries: DataFrame | None = None,
    cities: DataFrame | None = None,
    tiers: DataFrame | None = None,
    cuisines: DataFrame | None = None,
) -> DataFrame:
    """Carry selections on dimension tables to the fact, along the star's relations.

    Country, city and tier filter the fact by their key. A cuisine selection goes up
    the bridge, so it keeps a venue once however many of its cuisines are selected. The
    selections are counted first, so that the fact is not shuffled for a small one.
    """
    kept = fact
    for dimension, key in ((countries, "country_code"), (cities, "city"), (tiers, "price_range")):
        if dimension is not None:
            kept = kept.join(keys_of(dimension, key), key, "left_semi")
    if cuisines is not None:
        selected = bridge.join(keys_of(cuisines, "cuisine"), "cuisine", "left_semi")
        kept = kept.join(selected, "venue_id", "left_semi")
    return kept


def currency_mean(column: str, currency: str) -> Column:
    """Mean over one currency, on top of whatever filter the frame already has."""
    return F.avg(F.when(F.col("currency") == currency, F.col(column)))


def scope_line(fact: DataFrame, spec: FilterSpec) -> DataFrame:
    """Rows in the filter context, of rows in total, in one pass."""
    return fact.agg(
        F.count_if(predicate(spec)).alias("in_scope"), F.count(F.lit(1)).alias("total")
    )


def by_ids(fact: DataFrame, ids: Sequence[int]) -> DataFrame:
    """The venues of a list of ids, as a test that the Parquet scan can use."""
    return fact.where(F.col("venue_id").isin(list(ids)))


def drill_through(fact: DataFrame, locality: str) -> DataFrame:
    """Every venue of one locality, best rated first."""
    return fact.where(F.col("locality") == locality).orderBy(
        F.desc_nulls_last("rating"), F.desc("votes"), "venue_id"
    )
