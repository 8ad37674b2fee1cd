"""One scope reduced once to small tables, from which its grouped figures roll up.

Venues are counted and summed in cells of everything the small tables group by. Counts, sums
and maxima of cells add up to those of any coarser group, so a city, a locality, a tier, a band
and the whole scope come from the same written table, and the fact is not read again for them.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.config import RATING_BANDS, TREND_BANDS, Bands
from venuelens.functions import statistics as S
from venuelens.operators import measures, opportunity, ordering, ranking
from venuelens.operators.measures import only_row, ratio
from venuelens.sources.shared import written


# Venues that correlations compare.
COMPARABLE = "credible AND cost IS NOT NULL AND rating IS NOT NULL"


def cells(fact: DataFrame, rating_bands: Bands = RATING_BANDS, trend_bands: Bands = TREND_BANDS) -> DataFrame:
    """Mergeable totals by area, tier, delivery and both bands."""
    placed = fact.withColumns(
        {
            "rating_position": measures.rating_position(rating_bands),
            "trend_position": measures.trend_position(trend_bands),
        }
    )
    keys = ["city", "locality", "price_label", "has_delivery", "rating_position", "trend_position"]
    return placed.groupBy(*keys).agg(*measures.mergeable())


def value_counts(fact: DataFrame) -> DataFrame:
    """(credible, cost, rating, w): the venues of each combination, from which quantiles and ranks follow."""
    return fact.groupBy("credible", "cost", "rating").agg(measures.venue_count().alias("w"))


def ranked_values(values: DataFrame) -> DataFrame:
    """All known costs, and costs and ratings of the venues that a rank correlation compares, numbered together."""
    known = F.expr(COMPARABLE)
    columns = {"any_cost": F.col("cost"), "cost": F.when(known, F.col("cost")), "rating": F.when(known, F.col("rating"))}
    return ordering.numbered(values, columns, F.col("w"))


@dataclass(frozen=True)
class Summary:
    """A scope's written tables: cells, value counts and their ranks, cuisines, and the venues on its boards."""

    fact: DataFrame
    cells: DataFrame
    values: DataFrame
    ranks: DataFrame
    cuisines: DataFrame
    boards: DataFrame

    def kpis(self) -> DataFrame:
        """The KPI strip, as ``measures.kpis`` gives it."""
        costs = self.ranks.where("series = 'any_cost'")
        quantiles = ordering.quantiles_of(costs, {"median_cost": 0.5, "p90_cost": 0.9})

        def first(board: str, field: str):
            return F.max(F.when((F.col("board") == board) & (F.col("place") == 1), F.col(field)))

        named = self.boards.agg(
            first("top_rated", "venue_name").alias("top_name"),
            first("top_rated", "rating").alias("top_rating"),
            first("most_expensive", "venue_name").alias("priciest_name"),
        )
        strip = self.cells.agg(*measures.headline_columns())
        strip = strip.withColumns(
            {
                "cost": only_row(quantiles),
                "named": only_row(named),
                "cuisines": self.cuisines.agg(F.count("cuisine")).scalar(),
            }
        )
        return strip.select(*measures.STRIP)

    def localities(self, floor: int) -> DataFrame:
        """As ``opportunity.locality_totals`` gives them."""
        grouped = self.cells.where("city is not null and locality is not null").groupBy("city", "locality").agg(
            F.sum("venues").alias("restaurants"),
            ratio("rating", "ratings").alias("avg_rating"),
            ratio("cost", "costed").alias("avg_cost"),
            S.total(F.col("votes")).alias("total_votes"),
        )
        return opportunity.supported(grouped, floor)

    def spearman(self) -> DataFrame:
        known = self.values.where(COMPARABLE).select("cost", "rating", "w")
        return measures.spearman_of(known, self.ranks.withColumn("rank", ordering.average_rank()), "cost", "rating")

    def top_cuisine_share(self, top: int = 3) -> DataFrame:
        return measures.share_serving(self.fact, self.cuisines, top)


def summarise(
    fact: DataFrame, boards: Mapping[str, ranking.Board], rating_bands: Bands = RATING_BANDS, trend_bands: Bands = TREND_BANDS
) -> Summary:
    """Reduce a scope: one scan each for cells, values and cuisines, two for the boards, all written to the shared folder."""
    tables = {
        "cells": lambda: cells(fact, rating_bands, trend_bands),
        "ranks": lambda: ranked_values(values.result()),
        "cuisines": lambda: measures.per_cuisine(measures.exploded(fact)),
        "boards": lambda: ranking.with_places(fact, written(ranking.places(fact, boards), "places")),
    }
    # Separate jobs that do not wait for one another, but for the ranks of the values.
    with ThreadPoolExecutor(len(tables) + 1) as pool:
        run = inheritable_thread_target(fact.sparkSession)(lambda name, table: written(table(), name))
        values = pool.submit(run, "values", lambda: value_counts(fact))
        found = {name: pool.submit(run, name, table) for name, table in tables.items()}
        return Summary(fact, values=values.result(), **{name: f.result() for name, f in found.items()})
