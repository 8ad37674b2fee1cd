"""Measures over the fact in whatever filter context it comes.

The fact holds a venue once, so counting its rows counts venues. Cuisine measures
explode the venue's own list, which holds a cuisine once, so rows per cuisine are
venues per cuisine too: no join with the bridge and no distinct count is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.config import RATING_BANDS, TREND_BANDS, Bands, Floors
from venuelens.functions import columns as C
from venuelens.functions import statistics as S
from venuelens.operators.dimensions import literal_frame
from venuelens.operators.filters import currency_mean
from venuelens.operators.ordering import average_rank, numbered, quantiles, ranks_in

def venue_count() -> Column:
    return F.count(F.lit(1))


# -- headline figures -------------------------------------------------------
def only_row(df: DataFrame) -> Column:
    """A one-row table as a struct to use inside another query: a scalar subquery,
    run once however many of its fields are read."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()


def mergeable() -> list[Column]:
    """Totals of a group of venues that add up to those of any larger group."""
    return [
        venue_count().alias("venues"),
        F.count("cost").alias("costed"),
        F.sum("cost").alias("cost"),
        F.max("cost").alias("max_cost"),
        F.sum("rating").alias("rating"),
        F.count("rating").alias("ratings"),
        F.count_if("is_rated").alias("rated"),
        F.count_if("credible").alias("credible"),
        F.count_if("has_delivery").alias("delivery"),
        F.count("has_delivery").alias("delivery_known"),
        F.count_if("has_booking").alias("booking"),
        F.count("has_booking").alias("booking_known"),
        F.sum("votes").alias("votes"),
        F.count("votes").alias("voted"),
        F.sum("cuisine_count").alias("cuisine_count"),
        F.count("cuisine_count").alias("cuisine_counted"),
    ]


def area_totals(fact: DataFrame, *outer: str) -> DataFrame:
    """Mergeable totals per (city, locality): the one shuffle behind the headline
    figures, after which distinct counts run over areas instead of venues."""
    return fact.groupBy(*outer, "city", "locality").agg(*mergeable())


def ratio(amount: str, n: str) -> Column:
    """Mean of a measure from its totals, null where nothing was counted."""
    return F.try_divide(F.sum(amount), F.sum(n))


def extremes(fact: DataFrame) -> DataFrame:
    """Name and rating of the top credible venue and name of the dearest one, the lowest id first
    among equals. Each is a top-1, of which a task sends one row, over the columns that order it."""
    best = fact.where("credible").orderBy(F.desc("rating"), F.desc("votes"), "venue_id").limit(1)
    dearest = fact.where("cost is not null").orderBy(F.desc("cost"), "venue_id").limit(1)
    named = fact.sparkSession.range(0, 1, 1, 1).select(
        only_row(best.select("venue_name", "rating")).alias("best"),
        only_row(dearest.select("venue_name")).alias("dearest"),
    )
    return named.select(
        F.col("best.venue_name").alias("top_name"),
        F.col("best.rating").alias("top_rating"),
        F.col("dearest.venue_name").alias("priciest_name"),
    )


def cost_quantiles(fact: DataFrame) -> DataFrame:
    return quantiles(fact, "cost", {"median_cost": 0.5, "p90_cost": 0.9})


STRIP = [
    "restaurants", "cities", "localities", "avg_cost", "cost.median_cost", "cost.p90_cost", "max_cost", "avg_rating",
    "rated_n", "not_rated_n", "not_rated_pct", "delivery_pct", "booking_pct", "total_votes", "avg_votes", "cuisines",
    "avg_cuisines", "credible_n", "named.top_name", "named.top_rating", "named.priciest_name",
]


def headline_columns() -> list[Column]:
    """The figures of the KPI strip that follow from mergeable totals by area."""
    venues = S.total(F.col("venues"))
    return [
        venues.alias("restaurants"),
        F.count_distinct("city").alias("cities"),
        F.count_distinct("locality").alias("localities"),
        ratio("cost", "costed").alias("avg_cost"),
        F.max("max_cost").alias("max_cost"),
        ratio("rating", "ratings").alias("avg_rating"),
        S.total(F.col("rated")).alias("rated_n"),
        (venues - S.total(F.col("rated"))).alias("not_rated_n"),
        C.percent(venues - S.total(F.col("rated")), venues).alias("not_rated_pct"),
        (ratio("delivery", "delivery_known") * 100).alias("delivery_pct"),
        (ratio("booking", "booking_known") * 100).alias("booking_pct"),
        S.total(F.col("votes")).alias("total_votes"),
        ratio("votes", "voted").alias("avg_votes"),
        ratio("cuisine_count", "cuisine_counted").alias("avg_cuisines"),
        S.total(F.col("credible")).alias("credible_n"),
    ]


def kpis(fact: DataFrame) -> DataFrame:
    """The KPI strip as one row. No rows in context gives zero counts and nulls."""
    headline = area_totals(fact).agg(*headline_columns())
    cuisines = fact.select(F.explode("cuisine_list").alias("cuisine")).agg(
        F.count_distinct("cuisine").alias("n")
    )
    parts = headline.withColumns(
        {
            "cost": only_row(cost_quantiles(fact)),
            "named": only_row(extremes(fact)),
            "cuisines": cuisines.scalar(),
        }
    )
    return parts.select(*STRIP)


def dataset_facts(fact: DataFrame) -> DataFrame:
    """Rows, countries and cities of the whole fact."""
    per_city = fact.groupBy("country", "city").agg(venue_count().alias("rows"))
    return per_city.agg(
        S.total(F.col("rows")).alias("rows"),
        F.count_distinct("country").alias("countries"),
        F.count_distinct("city").alias("cities"),
    )


def cost_skewness(fact: DataFrame) -> DataFrame:
    return fact.agg(S.adjusted_skewness(F.col("cost")).alias("cost_skew"))


def cost_profile(fact: DataFrame) -> DataFrame:
    """Mean, exact median and 90th percentile, and adjusted skewness of cost."""
    moments = fact.agg(
        F.avg("cost").alias("avg_cost"), S.adjusted_skewness(F.col("cost")).alias("cost_skew")
    )
    return moments.withColumn("cost", only_row(cost_quantiles(fact))).select(
        "avg_cost", "cost.median_cost", "cost.p90_cost", "cost_skew"
    )


def naive_bias(fact: DataFrame) -> DataFrame:
    """Mean rating, the mean if unrated venues counted as 0, and the difference."""
    means = fact.agg(
        F.avg(F.when(F.col("is_rated"), F.col("rating"))).alias("avg_rating"),
        F.avg(F.coalesce("rating", F.lit(0.0))).alias("naive_rating"),
    )
    return means.withColumn("bias_avoided", F.col("avg_rating") - F.col("naive_rating"))


def rates(fact: DataFrame) -> DataFrame:
    """Counts and percentages of venues by flag; blank when no venue is in context."""
    return fact.agg(
        venue_count().alias("restaurants"),
        F.count_if("is_rated").alias("rated_n"),
        F.count_if(~F.col("is_rated")).alias("not_rated_n"),
        S.share_of_rows(~F.col("is_rated")).alias("not_rated_pct"),
        F.count_if("credible").alias("credible_n"),
        S.share_of_rows(F.col("has_delivery")).alias("delivery_pct"),
        S.share_of_rows(F.col("has_booking")).alias("booking_pct"),
        S.total(F.col("votes")).alias("total_votes"),
        F.try_divide(F.sum("votes"), venue_count()).alias("votes_per_venue"),
    )


def service_adoption(fact: DataFrame) -> DataFrame:
    """Four shares, as rows."""
    shares = fact.agg(
        S.share_true(F.col("has_delivery")).alias("Online delivery"),
        S.share_true(F.col("has_booking")).alias("Table booking"),
        S.share_of_rows(F.col("is_rated")).alias("Has at least one rating"),
        S.share_of_rows(F.col("credible")).alias("Credible rating"),
    )
    return shares.unpivot([], shares.columns, "service", "share_pct")


def share_columns(metro_cities: Sequence[str]) -> list[Column]:
    return [
        S.share_of_rows(F.col("cuisine_count") == 1).alias("single_cuisine_pct"),
        S.share_of_rows(F.col("price_range") <= 2).alias("budget_pct"),
        C.percent(F.count_if(F.col("rating") >= 4.0), F.count_if("is_rated")).alias("rated_4_plus_pct"),
        F.count_if(F.col("rating") >= 4.0).alias("rated_4_plus_n"),
        S.share_of_rows(F.col("city").isin(list(metro_cities))).alias("metro_pct"),
    ]


def share_measures(fact: DataFrame, metro_cities: Sequence[str]) -> DataFrame:
    """Single-cuisine, budget, 4.0-and-over and metro shares."""
    return fact.agg(*share_columns(metro_cities))


def cheap_vs_luxury(fact: DataFrame, cheap_below: float, luxury_from: float) -> DataFrame:
    """Mean rating of credible venues at both ends of the price list."""
    cheap, luxury = F.col("cost") < cheap_below, F.col("cost") >= luxury_from
    return fact.where("credible").agg(
        F.avg(F.when(cheap, F.col("rating"))).alias("cheap_rating"),
        F.count_if(cheap).alias("cheap_n"),
        F.avg(F.when(luxury, F.col("rating"))).alias("luxury_rating"),
        F.count_if(luxury).alias("luxury_n"),
    )


# -- bands and tiers, empty ones kept ---------------------------------------
def in_bands(grouped: DataFrame, bands: Bands) -> DataFrame:
    """Measures by ``position`` with the names of all bands, empty ones too."""
    labels = literal_frame(
        grouped.sparkSession,
        T.StructType(
            [T.StructField("position", T.IntegerType()), T.StructField("band", T.StringType())]
        ),
        list(enumerate(bands.labels, 1)),
    )
    # Both sides have one row per band.
    return labels.join(F.broadcast(grouped), "position", "left").withColumn(
        "restaurants", F.coalesce("restaurants", F.lit(0))
    )


def _per_band(df: DataFrame, value: Column, bands: Bands, measures: Sequence[Column]) -> DataFrame:
    return in_bands(df.withColumn("position", C.band_index(value, bands)).groupBy("position").agg(*measures), bands)


def rating_position(bands: Bands = RATING_BANDS) -> Column:
    """The half-star band of a rated venue, null for the unrated."""
    return F.when(F.col("is_rated"), C.band_index(F.col("rating"), _open_ended(bands)))


def trend_position(bands: Bands = TREND_BANDS) -> Column:
    """The cost band of a credible venue with a cost and a rating, else null."""
    known = F.col("credible") & F.col("cost").isNotNull() & F.col("rating").isNotNull()
    return F.when(known, C.band_index(F.col("cost"), bands))


def _open_ended(bands: Bands) -> Bands:
    """The bands with the first open below and the last open above."""
    return Bands(edges=[float("-inf"), *bands.edges[1:-1], None], labels=bands.labels)


def rating_histogram(fact: DataFrame, bands: Bands = RATING_BANDS) -> DataFrame:
    """Rated venues per half-star band, in the bands of ``rating_band``: all are counted."""
    rated = fact.where("is_rated")
    return (
        _per_band(rated, F.col("rating"), _open_ended(bands), [venue_count().alias("restaurants")])
        .orderBy("position")
        .select("position", "band", "restaurants")
    )


def rating_band(fact: DataFrame, not_rated: str, bands: Bands = RATING_BANDS) -> DataFrame:
    """Each venue's half-star band, with the unrated named. Ratings under the first
    edge belong to the first band and ratings over the last to the last."""
    label = F.coalesce(C.band(F.col("rating"), _open_ended(bands)), F.lit(not_rated))
    return fact.select("venue_id", "rating", label.alias("rating_band"))


def cost_band_trend(fact: DataFrame, bands: Bands = TREND_BANDS) -> DataFrame:
    """Mean rating of credible venues per cost band; empty bands stay, with no mean."""
    known = fact.where(F.col("credible") & F.col("cost").isNotNull() & F.col("rating").isNotNull())
    measures = [F.avg("rating").alias("avg_rating"), venue_count().alias("restaurants")]
    return (
        _per_band(known, F.col("cost"), bands, measures)
        .orderBy("position")
        .select("position", "band", "avg_rating", "restaurants")
    )


def cost_bands_in_order(fact: DataFrame, bands: Bands) -> DataFrame:
    """Venues and mean rating per stored cost band, in band order, unknown last."""
    grouped = fact.groupBy("cost_band").agg(
        venue_count().alias("restaurants"), F.avg("rating").alias("avg_rating")
    )
    return grouped.withColumn("sort_key", C.band_sort_key(F.col("cost_band"), bands)).orderBy("sort_key")


def tier_summary(fact: DataFrame, labels: dict[int, str], keep_empty: bool = True) -> DataFrame:
    """Measures per price tier in tier order, with each tier's share of all venues."""
    grouped = fact.groupBy("price_label").agg(
        venue_count().alias("n"),
        F.avg("rating").alias("avg_rating"),
        F.avg("cost").alias("avg_cost"),
        S.share_true(F.col("has_delivery")).alias("delivery_pct"),
        S.share_true(F.col("has_booking")).alias("booking_pct"),
        F.avg("votes").alias("avg_votes"),
    )
    return in_tiers(grouped, labels, keep_empty)


def in_tiers(grouped: DataFrame, labels: dict[int, str], keep_empty: bool = True) -> DataFrame:
    """Measures by ``price_label``, with ``n`` venues, in tier order with each tier's share."""
    # Tier names come from the fixed labels, so this window spans a handful of rows.
    grouped = grouped.withColumn("total", F.sum("n").over(Window.partitionBy()))
    tiers = literal_frame(
        grouped.sparkSession,
        T.StructType(
            [T.StructField("price_range", T.IntegerType()), T.StructField("price_label", T.StringType())]
        ),
        sorted(labels.items()),
    )
    joined = tiers.join(F.broadcast(grouped), "price_label", "left" if keep_empty else "inner")
    restaurants = F.coalesce("n", F.lit(0))
    return joined.select(
        "price_range",
        "price_label",
        restaurants.alias("restaurants"),
        C.percent(restaurants, F.max("total").over(Window.partitionBy())).alias("share_pct"),
        "avg_rating",
        "avg_cost",
        "delivery_pct",
        "booking_pct",
        "avg_votes",
    ).orderBy("price_range")


# -- groups with a support floor --------------------------------------------
def _place_measures() -> list[Column]:
    return [
        venue_count().alias("restaurants"),
        F.avg("cost").alias("avg_cost"),
        F.avg("rating").alias("avg_rating"),
        S.share_true(F.col("has_delivery")).alias("delivery_pct"),
        S.share_true(F.col("has_booking")).alias("booking_pct"),
        S.total(F.col("votes")).alias("total_votes"),
    ]


def city_summary(fact: DataFrame, floor: int = Floors().city) -> DataFrame:
    """Cities with enough venues, without the median: one shuffle. Unordered."""
    grouped = fact.where(F.col("city").isNotNull()).groupBy("city").agg(*_place_measures())
    return grouped.where(F.col("restaurants") >= floor)


def city_benchmark(fact: DataFrame, floor: int = Floors().city) -> DataFrame:
    """Cities with enough venues, with the exact median cost, largest first."""
    medians = quantiles(fact, "cost", {"median_cost": 0.5}, keys=["city"])
    return (
        city_summary(fact, floor)
        .join(medians, "city", "left")
        .select(
            "city",
            "restaurants",
            "avg_cost",
            "median_cost",
            "avg_rating",
            "delivery_pct",
            "booking_pct",
            "total_votes",
        )
        .orderBy(F.desc("restaurants"), "city")
    )


def top_cities(fact: DataFrame, limit: int = 15) -> DataFrame:
    cities = fact.where(F.col("city").isNotNull()).groupBy("city").agg(venue_count().alias("restaurants"))
    return cities.orderBy(F.desc("restaurants"), "city").limit(limit)


def exploded(fact: DataFrame) -> DataFrame:
    """The fact at venue-cuisine grain."""
    return fact.withColumn("cuisine", F.explode("cuisine_list"))


def bridge_with_fact(bridge: DataFrame, fact: DataFrame) -> DataFrame:
    """A separate bridge, restricted to the venues of the fact, with their measures.

    Keeping the pairs of known venues and then looking the venue up is one inner join,
    because a venue is in the fact once.
    """
    return bridge.join(fact.select("venue_id", "rating", "cost", "votes", "has_delivery"), "venue_id")


def per_cuisine(pairs: DataFrame) -> DataFrame:
    """Cuisine measures over distinct (venue, cuisine) rows with the venue's measures."""
    return (
        pairs.where(F.col("cuisine").isNotNull())
        .groupBy("cuisine")
        .agg(
            venue_count().alias("restaurants"),
            F.avg("rating").alias("avg_rating"),
            F.avg("cost").alias("avg_cost"),
            S.total(F.col("votes")).alias("total_votes"),
            S.share_true(F.col("has_delivery")).alias("delivery_pct"),
        )
    )


def cuisine_summary(fact: DataFrame) -> DataFrame:
    return per_cuisine(exploded(fact)).orderBy(F.desc("restaurants"), "cuisine")


def cuisines_by_rating(fact: DataFrame, floor: int = Floors().cuisine, limit: int = 12) -> DataFrame:
    return best_cuisines(per_cuisine(exploded(fact)), floor, limit)


def best_cuisines(cuisines: DataFrame, floor: int, limit: int) -> DataFrame:
    """The best rated rows of a cuisine table with enough venues."""
    ranked = cuisines.where((F.col("restaurants") >= floor) & F.col("avg_rating").isNotNull())
    # The mean is rounded for ordering so that equal means tie however they were summed.
    return (
        ranked.orderBy(F.desc(F.round("avg_rating", 9)), "cuisine")
        .select("cuisine", "restaurants", "avg_rating", "avg_cost")
        .limit(limit)
    )


def top_cuisine_share(fact: DataFrame, top: int = 3) -> DataFrame:
    """Percent of venues serving at least one of the most common cuisines."""
    return share_serving(fact, exploded(fact).groupBy("cuisine").agg(venue_count().alias("restaurants")), top)


def share_serving(fact: DataFrame, cuisines: DataFrame, top: int) -> DataFrame:
    """Percent of venues serving at least one of the ``top`` rows of a cuisine table."""
    leaders = cuisines.orderBy(F.desc("restaurants"), "cuisine").limit(top)
    # One row holding ``top`` names, put to every venue's own list: the venues are
    # neither joined nor shuffled.
    names = leaders.agg(F.array_sort(F.collect_list("cuisine")).alias("names")).scalar()
    tested = fact.select(names.alias("names"), "cuisine_list")
    hit = F.arrays_overlap("cuisine_list", "names")
    return tested.agg(
        F.concat_ws(", ", F.max("names")).alias("cuisines"), S.share_of_rows(hit).alias("share_pct")
    )


def delivery_effect(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("has_delivery").isNotNull())
        .groupBy("has_delivery")
        .agg(
            venue_count().alias("restaurants"),
            F.avg("rating").alias("avg_rating"),
            F.avg("votes").alias("avg_votes"),
            F.avg("cost").alias("avg_cost"),
        )
        .orderBy("has_delivery")
    )


def country_overview(fact: DataFrame) -> DataFrame:
    """Measures that need no currency, per country."""
    return (
        fact.where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(
            venue_count().alias("restaurants"),
            F.avg("rating").alias("avg_rating"),
            F.avg("price_range").alias("avg_price_range"),
            S.share_true(F.col("has_delivery")).alias("delivery_pct"),
            S.share_true(F.col("has_booking")).alias("booking_pct"),
        )
        .orderBy(F.desc("restaurants"), "country")
    )


def facets(fact: DataFrame) -> DataFrame:
    """Slicer values with their counts, for city and cuisine: two scans of one column."""

    def counts(rows: DataFrame, facet: str) -> DataFrame:
        known = rows.where(F.col(facet).isNotNull()).groupBy(facet).agg(venue_count().alias("n"))
        return known.select(F.lit(facet).alias("facet"), F.col(facet).alias("value"), "n")

    both = counts(fact, "city").unionByName(counts(exploded(fact), "cuisine"))
    return both.orderBy("facet", F.desc("n"), "value")


def metro_contrast(fact: DataFrame, metro_cities: Sequence[str], floor: int = Floors().city) -> DataFrame:
    """Benchmarked metro cities against the others: unweighted means of city means."""
    cities = city_summary(fact, floor).withColumn("is_metro", F.col("city").isin(list(metro_cities)))
    return (
        cities.groupBy("is_metro")
        .agg(venue_count().alias("cities"), F.avg("avg_rating").alias("mean_city_rating"))
        .orderBy("is_metro")
    )


def value_ratio(fact: DataFrame, axis: str) -> DataFrame:
    """Value score of a group: its mean rating over its mean cost, not a mean of ratios."""
    return fact.groupBy(axis).agg(
        venue_count().alias("restaurants"),
        C.value_per_hundred(F.avg("rating"), F.avg("cost")).alias("value_ratio"),
    )


def skew_flag(fact: DataFrame, axis: str, threshold: float = 0.2) -> DataFrame:
    """Which of mean and median to quote for the cost of each group."""
    means = fact.where(F.col(axis).isNotNull()).groupBy(axis).agg(F.avg("cost").alias("avg_cost"))
    medians = quantiles(fact, "cost", {"median_cost": 0.5}, keys=[axis])
    excess = F.try_divide(F.col("avg_cost") - F.col("median_cost"), F.col("median_cost"))
    return means.join(medians, axis, "left").select(
        axis,
        "avg_cost",
        "median_cost",
        F.when(excess > threshold, "quote the median").otherwise("the mean is safe").alias("advice"),
    )


def metric_by(fact: DataFrame, axis: str, metric: str) -> DataFrame:
    """One measure chosen by name, per group."""
    measures = {
        "restaurants": venue_count(),
        "avg_rating": F.avg("rating"),
        "avg_cost": F.avg("cost"),
        "votes": F.sum("votes"),
    }
    value = measures[metric].cast("double").alias("value")
    return fact.groupBy(axis).agg(value).select(axis, F.lit(metric).alias("metric"), "value")


def currency_page(fact: DataFrame, currency: str) -> DataFrame:
    """Per country, cost over one currency only: blank where that currency is absent."""
    return (
        fact.groupBy("country")
        .agg(venue_count().alias("restaurants"), currency_mean("cost", currency).alias("avg_cost"))
        .orderBy("country")
    )


# -- correlation and difference ---------------------------------------------
def correlation_columns(n: str = "n") -> list[Column]:
    known = F.col("credible") & F.col("cost").isNotNull() & F.col("rating").isNotNull()
    cost, votes, rating = (F.when(known, value) for value in (F.col("cost"), F.log1p("votes"), F.col("rating")))
    return [
        S.pearson(cost, rating).alias("pearson_cost"),
        S.pearson(votes, rating).alias("pearson_votes"),
        F.count_if(known).alias(n),
    ]


def correlations(fact: DataFrame) -> DataFrame:
    """Pearson of cost and of log votes with rating, over credible venues."""
    return fact.agg(*correlation_columns())


def spearman(fact: DataFrame, x: str = "cost", y: str = "rating") -> DataFrame:
    """Rank correlation over credible venues.

    Ranks belong to distinct values and rows collapse to distinct pairs first, so a
    value shared by many venues is one row in every join. Both columns are ranked in the same passes.
    """
    known = fact.where(F.col("credible") & F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    pairs = known.groupBy(x, y).agg(venue_count().alias("w"))
    ranks = numbered(pairs, {x: F.col(x), y: F.col(y)}, F.col("w"))
    return spearman_of(pairs, ranks.withColumn("rank", average_rank()), x, y)


def spearman_of(pairs: DataFrame, ranks: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation of distinct pairs with their number of venues ``w``, from the ranks of both columns."""
    ranked = pairs.join(ranks_in(ranks, x, x, "rx"), x).join(ranks_in(ranks, y, y, "ry"), y)
    w, rx, ry = F.col("w").cast("double"), F.col("rx"), F.col("ry")
    # Average ranks keep the mean of plain ranks, (n + 1) / 2, whatever the ties.
    sums = ranked.agg(
        F.sum(w).alias("n"),
        F.sum(w * rx * ry).alias("xy"),
        F.sum(w * rx * rx).alias("xx"),
        F.sum(w * ry * ry).alias("yy"),
    )
    n = F.col("n")
    mean_square = ((n + 1) / 2) * ((n + 1) / 2)

    def spread(column: str) -> Column:
        return F.col(column) / n - mean_square

    rho = F.try_divide(spread("xy"), F.sqrt(spread("xx") * spread("yy")))
    return sums.select(
        F.when(n >= 3, rho).alias("spearman"), F.coalesce(n, F.lit(0)).cast("long").alias("n")
    )


def delivery_difference_columns() -> list[Column]:
    parts = S.welch_t(F.when(F.col("is_rated"), F.col("rating")), F.col("has_delivery"))
    return [column.alias(name) for name, column in parts.items()]


def delivery_difference(fact: DataFrame) -> DataFrame:
    """Welch test of rated venues that deliver against those that do not."""
    return fact.agg(*delivery_difference_columns())
