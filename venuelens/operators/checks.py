"""Reconciliation as data jobs: two sets of figures, or one set against its own rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.config import Floors, FilterSpec
from venuelens.operators import filters, measures, opportunity, ranking


def as_long(row: DataFrame) -> DataFrame:
    """A one-row table of figures as (metric, number, text)."""
    entries = []
    for field in row.schema.fields:
        is_text = field.dataType.simpleString() == "string"
        number = F.lit(None).cast("double") if is_text else F.col(field.name).cast("double")
        text = F.col(field.name) if is_text else F.lit(None).cast("string")
        entries.append(
            F.struct(F.lit(field.name).alias("metric"), number.alias("number"), text.alias("text"))
        )
    return row.select(F.inline(F.array(*entries)))


def reconcile(
    actual: DataFrame, expected: DataFrame, tolerance: Mapping[str, float] | None = None
) -> DataFrame:
    """Compare two (metric, number, text) tables metric by metric.

    Two blanks agree, texts must be equal, numbers may differ by the metric's
    tolerance (0 unless given). A metric on one side only agrees only if blank.
    """
    allowed = F.lit(0.0)
    for metric, value in (tolerance or {}).items():
        allowed = F.when(F.col("metric") == metric, F.lit(float(value))).otherwise(allowed)
    a = actual.select("metric", F.col("number").alias("actual"), F.col("text").alias("actual_text"))
    e = expected.select(
        "metric", F.col("number").alias("expected"), F.col("text").alias("expected_text")
    )
    same_number = F.coalesce(
        F.abs(F.col("actual") - F.col("expected")) <= allowed,
        F.col("actual").isNull() & F.col("expected").isNull(),
    )
    same_text = F.col("actual_text").eqNullSafe(F.col("expected_text"))
    return a.join(e, "metric", "full_outer").withColumn("passed", same_number & same_text)


def _checks(row: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """One row of figures to one row per check; an unknown outcome is a failure."""
    entries = [
        F.struct(F.lit(name).alias("check"), F.coalesce(test, F.lit(False)).alias("passed"))
        for name, test in tests.items()
    ]
    return row.select(F.inline(F.array(*entries)))


def invariants(
    fact: DataFrame, floors: Floors, tier_labels: Mapping[int, str], value_floor: float = 4.0
) -> DataFrame:
    """Rules every correct set of measures obeys, as (check, passed)."""
    base = fact.agg(
        measures.venue_count().alias("venues"),
        F.count_if("is_rated").alias("rated"),
        F.min("rating").alias("lowest"),
        F.min("cost").alias("cheapest"),
    )
    tiers = measures.tier_summary(fact, dict(tier_labels))
    histogram = measures.rating_histogram(fact)
    cuisines = measures.cuisine_summary(fact)
    localities = opportunity.opportunity(fact, floors.locality)
    board = ranking.best_value(fact, rating_floor=value_floor)
    currencies = (
        fact.where(F.col("cost").isNotNull())
        .groupBy("country", "currency")
        .agg(F.lit(1).alias("one"))
        .groupBy("country")
        .agg(F.sum("one").alias("n"))
    )

    def figure(df: DataFrame, value: Column) -> Column:
        return df.agg(value.alias("v")).scalar()

    row = base.withColumns(
        {
            "tier_sum": figure(tiers, F.sum("restaurants")),
            # One entry per fixed tier.
            "tier_order": figure(tiers, F.array_sort(F.collect_list(F.struct("price_range", "price_label")))),
            "histogram_sum": figure(histogram, F.sum("restaurants")),
            "cuisine_sum": figure(cuisines, F.sum("restaurants")),
            "smallest_locality": figure(localities, F.min("restaurants")),
            "board_floor": figure(board, F.min("rating")),
            "most_currencies": figure(currencies, F.max("n")),
        }
    )
    return _checks(
        row,
        {
            "tiers sum to the venue count": F.col("tier_sum") == F.col("venues"),
            "tiers are in ascending order": F.col("tier_order.price_label")
            == F.array_sort(F.col("tier_order.price_label")),
            "histogram sums to the rated count": F.col("histogram_sum") == F.col("rated"),
            "cuisine appearances exceed the venue count": F.col("cuisine_sum") > F.col("venues"),
            "scored localities respect the floor": F.coalesce(F.col("smallest_locality") >= floors.locality, F.lit(True)),
            "value board respects the rating floor": F.coalesce(F.col("board_floor") >= value_floor, F.lit(True)),
            "no rating of 0 is left": F.coalesce(F.col("lowest") > 0, F.lit(True)),
            "no cost of 0 or less is left": F.coalesce(F.col("cheapest") > 0, F.lit(True)),
            "a country has one currency": F.coalesce(F.col("most_currencies") <= 1, F.lit(True)),
        },
    )


def filter_invariants(
    fact: DataFrame, city: str, impossible: FilterSpec, tiers: Sequence[int] = (1,), cuisines: Sequence[str] = (),
    search: str = "",
) -> DataFrame:
    """Rules of the filter layer as (check, passed), measured on the filtered frames."""

    def kept(spec: FilterSpec, belongs: Column) -> Column:
        """Rows that a filter keeps, and those of them that do not belong."""
        counts = F.struct(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(belongs, F.lit(False))).alias("strays"))
        return filters.apply_filters(fact, spec).agg(counts.alias("v")).scalar()

    has_cuisine = F.arrays_overlap("cuisine_list", F.array(*[F.lit(c) for c in cuisines]).cast("array<string>"))
    # Found without case, as a pattern with the text quoted: another way than the filter's.
    matches = F.concat_ws("\n", "venue_name", "locality").rlike("(?i)\\Q" + search.replace("\\E", "") + "\\E")
    base = fact.agg(
        measures.venue_count().alias("total"),
        F.count_if(F.col("city") == city).alias("city_rows"),
        F.count_if(F.col("price_range").isin(list(tiers))).alias("tier_rows"),
        F.count_if(has_cuisine).alias("cuisine_rows"),
        F.count_if("has_delivery").alias("delivery_rows"),
        F.count_if(matches).alias("search_rows"),
    )
    nothing = measures.kpis(filters.apply_filters(fact, impossible))
    city_kpis = measures.kpis(filters.apply_filters(fact, FilterSpec(cities=(city,))))
    row = base.withColumns(
        {
            "all": kept(FilterSpec(), F.lit(True)),
            "city": kept(FilterSpec(cities=(city,)), F.col("city") == city),
            "tier": kept(FilterSpec(price_tiers=tuple(tiers)), F.col("price_range").isin(list(tiers))),
            "cuisine": kept(FilterSpec(cuisines=tuple(cuisines)), has_cuisine) if cuisines else F.lit(None),
            "search": kept(FilterSpec(search=search), matches),
            "delivery": kept(FilterSpec(delivery_only=True), F.col("has_delivery")),
            "none": kept(impossible, F.lit(False)),
            "kpi_city": city_kpis.select("restaurants").scalar(),
            "kpi_none": nothing.select("restaurants").scalar(),
        }
    )

    def keeps(name: str) -> Column:
        return (F.col(f"{name}.strays") == 0) & (F.col(f"{name}.n") == F.col(f"{name}_rows"))

    tests = {
        "a city filter narrows the frame": (F.col("city.n") > 0) & (F.col("city.n") < F.col("total")),
        "a city filter keeps only that city": keeps("city"),
        "a tier filter keeps only those tiers": keeps("tier"),
        "an empty filter keeps every row": F.col("all.n") == F.col("total"),
        "an impossible filter is empty": F.col("none.n") == 0,
        "a flag filter keeps the flagged rows": keeps("delivery"),
        "figures compute on a filtered frame": F.col("kpi_city") == F.col("city_rows"),
        "figures compute on an empty frame": F.col("kpi_none") == 0,
    }
    if search:
        tests["a search keeps every venue that matches and no other"] = keeps("search")
    if cuisines:
        tests["a cuisine filter keeps only venues with one"] = keeps("cuisine")
    return _checks(row, tests)


def all_passed(*results: DataFrame) -> DataFrame:
    """Failed and total checks of several result tables."""
    stacked = reduce(DataFrame.unionByName, [r.select("passed") for r in results])
    return stacked.agg(
        F.count_if(~F.col("passed")).alias("failed"), F.count(F.lit(1)).alias("checks")
    )
