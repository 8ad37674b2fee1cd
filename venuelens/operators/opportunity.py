"""Where to open next: proven demand against a beatable incumbent rating.

The venues are reduced to localities once; scores, baselines and shortlists are
computed on that table. Baselines come from the rows in context, so they move with
the filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.config import Floors
from venuelens.functions import statistics as S
from venuelens.operators.measures import only_row, venue_count


def locality_totals(fact: DataFrame, floor: int = Floors().locality) -> DataFrame:
    """Localities with enough venues. Names repeat across cities, so both are the key."""
    keyed = fact.where(F.col("city").isNotNull() & F.col("locality").isNotNull())
    grouped = keyed.groupBy("city", "locality").agg(
        venue_count().alias("restaurants"),
        F.avg("rating").alias("avg_rating"),
        F.avg("cost").alias("avg_cost"),
        S.total(F.col("votes")).alias("total_votes"),
    )
    return supported(grouped, floor)


def supported(grouped: DataFrame, floor: int) -> DataFrame:
    """Localities with at least ``floor`` venues, with their votes per venue."""
    return grouped.where(F.col("restaurants") >= floor).withColumn(
        "votes_per_venue", F.col("total_votes") / F.col("restaurants")
    )


def score(localities: DataFrame, keep_unrated: bool = False) -> DataFrame:
    """Add ``demand_z``, ``quality_z`` and ``score`` = demand_z - quality_z.

    Localities without a rating are left out before the baseline is taken;
    ``keep_unrated`` keeps them, unscored but part of the demand baseline. Under
    three localities nothing is scored.
    """
    rows = localities if keep_unrated else localities.where(F.col("avg_rating").isNotNull())
    return _against(rows, rows)


def _against(rows: DataFrame, comparable: DataFrame) -> DataFrame:
    """Score ``rows`` against the baseline of the comparable localities.

    The baseline reads every measure of the table, so it and the scored rows share one
    aggregation of the venues: the exchange behind it is reused.
    """
    log_demand = F.log1p("votes_per_venue")
    baseline = comparable.agg(
        F.avg(log_demand).alias("demand_mean"),
        F.stddev_pop(log_demand).alias("demand_sd"),
        F.avg("avg_rating").alias("quality_mean"),
        F.stddev_pop("avg_rating").alias("quality_sd"),
        F.avg("avg_cost").alias("cost_mean"),
        F.count(F.lit(1)).alias("n"),
    )

    def z(value: Column, name: str) -> Column:
        sd = F.col(f"_base.{name}_sd")
        return (value - F.col(f"_base.{name}_mean")) / F.when(sd > 0, sd).otherwise(1.0)

    enough = F.col("_base.n") >= 3
    scored = rows.withColumn("_base", only_row(baseline)).withColumns(
        {
            "demand_z": F.when(enough, z(log_demand, "demand")),
            "quality_z": F.when(enough, z(F.col("avg_rating"), "quality")),
        }
    )
    return scored.withColumn("score", F.col("demand_z") - F.col("quality_z")).drop("_base")


def opportunity(fact: DataFrame, floor: int = Floors().locality, keep_unrated: bool = False) -> DataFrame:
    """Scored localities of the rows in context."""
    return score(locality_totals(fact, floor), keep_unrated)


def ranked_order() -> list[Column]:
    # Rounded so that equal scores tie however they were summed.
    return [F.desc_nulls_last(F.round("score", 9)), F.asc("city"), F.asc("locality")]


def shortlist(scored: DataFrame, n: int = 12, numbered: int = 5) -> DataFrame:
    """Best localities with the first few numbered."""
    best = scored.where(F.col("score").isNotNull()).orderBy(*ranked_order()).limit(n)
    # Numbering spans the ``n`` rows kept.
    place = F.row_number().over(Window.orderBy(*ranked_order()))
    return best.withColumn("rank", F.when(place <= numbered, place))


def bands(
    localities: DataFrame, floor: int, shortlist_from: float = 0.9, watch_from: float = 0.0
) -> DataFrame:
    """Every locality with its score and verdict; those under the floor are unscored and
    not part of the baseline. ``localities`` is ``locality_totals`` with a floor of 1.
    """
    comparable = (F.col("restaurants") >= floor) & F.col("avg_rating").isNotNull()
    scored = _against(localities, localities.where(comparable))
    verdict = (
        F.when(F.col("score").isNull(), "Not scored")
        .when(F.col("score") >= shortlist_from, "Shortlist")
        .when(F.col("score") >= watch_from, "Watch")
        .otherwise("Saturated or already strong")
    )
    return (
        scored.drop("demand_z", "quality_z")
        .withColumn("score", F.when(comparable, F.col("score")))
        .withColumn("band", verdict)
    )


def quadrant_lines(scored: DataFrame) -> DataFrame:
    """Reference lines: mean rating, and the geometric mean of demand floored at 1."""
    return scored.agg(
        F.avg("avg_rating").alias("rating_line"),
        F.exp(F.avg(F.ln(F.greatest("votes_per_venue", F.lit(1.0))))).alias("demand_line"),
    )


def busy_but_mediocre(scored: DataFrame) -> DataFrame:
    """Localities over the mean log demand whose rating is under the mean."""
    lines = scored.agg(
        F.avg("avg_rating").alias("rating"), F.avg(F.log1p("votes_per_venue")).alias("demand")
    )
    placed = scored.withColumn("_line", only_row(lines))
    weak = F.col("avg_rating") < F.col("_line.rating")
    busy = F.log1p("votes_per_venue") > F.col("_line.demand")
    return placed.where(weak & busy).drop("_line")


def shortlist_cost(scored: DataFrame, n: int = 12) -> DataFrame:
    best = scored.where(F.col("score").isNotNull()).orderBy(*ranked_order()).limit(n)
    return best.agg(F.avg("avg_cost").alias("shortlist_avg_cost"))
