"""Many filter contexts at once: their figures from one scan for each set of columns.

A venue is put into every context it is in, by number, and each figure is an aggregate by that
number. So the pages of a report, or all values of a slicer, cost the scans of one page.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.config import FilterSpec
from venuelens.operators import filters, measures, ordering, ranking
from venuelens.operators.dimensions import literal_frame

# Figures of the strip that are 0, not null, where a context is empty.
COUNTED = ("restaurants", "cities", "localities", "rated_n", "not_rated_n", "total_votes", "cuisines", "credible_n")


def numbers_of(specs: Sequence[FilterSpec]) -> Column:
    """The numbers of the contexts that a venue is in, as an array. A test on a missing value is no."""
    each = [F.when(filters.predicate(spec), F.lit(i)) for i, spec in enumerate(specs)]
    return F.filter(F.array(*each), lambda i: i.isNotNull())


def in_contexts(fact: DataFrame, specs: Sequence[FilterSpec]) -> DataFrame:
    """Every venue once for each context that it is in, numbered in ``context``; those in none are gone."""
    return fact.withColumn("context", F.explode(numbers_of(specs)))


def names_of(fact: DataFrame, specs: Mapping[str, FilterSpec]) -> DataFrame:
    """(context, name): one row for each, given by hand."""
    schema = T.StructType([T.StructField("context", T.IntegerType()), T.StructField("name", T.StringType())])
    return literal_frame(fact.sparkSession, schema, list(enumerate(specs)))


def scope_lines(fact: DataFrame, specs: Mapping[str, FilterSpec]) -> DataFrame:
    """(name, in_scope, total): rows in each context, of rows in total, in one pass without a shuffle of rows."""
    entries = [
        F.struct(F.lit(name).alias("name"), F.count_if(filters.predicate(spec)).alias("in_scope"), F.count(F.lit(1)).alias("total"))
        for name, spec in specs.items()
    ]
    return fact.agg(F.array(*entries).alias("lines")).select(F.inline("lines"))


def cost_quantiles(rows: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """Exact quantiles of cost by ``context``: each context's distinct costs are numbered, all in the same passes."""
    counted = rows.where(F.col("cost").isNotNull()).groupBy("context", F.col("cost").alias("value"))
    numbered = ordering.totals_below(counted.agg(measures.venue_count().alias("n")), "value", "n", ["context"])
    return ordering.quantiles_by(numbered, "context", probabilities)


def extremes(rows: DataFrame) -> DataFrame:
    """Top credible venue and dearest venue by ``context``, as ``measures.extremes`` names them.

    Ranks under a fixed limit: a task sends one row of each context and kind.
    """
    kinds = {
        "top": (F.col("credible"), F.col("rating"), F.col("votes")),
        "priciest": (F.col("cost").isNotNull(), F.col("cost"), F.lit(None)),
    }
    entries = [
        F.when(
            F.coalesce(eligible, F.lit(False)),
            F.struct(F.lit(kind).alias("kind"), first.cast("double").alias("k0"), second.cast("double").alias("k1")),
        )
        for kind, (eligible, first, second) in kinds.items()
    ]
    put_up = rows.select("context", "venue_id", "venue_name", "rating", F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    best = ranking.first_of(put_up, ["context", "kind"], [F.desc_nulls_last("k0"), F.desc_nulls_last("k1"), F.col("venue_id")])

    def of(kind: str, field: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(field)))

    return best.groupBy("context").agg(
        of("top", "venue_name").alias("top_name"),
        of("top", "rating").alias("top_rating"),
        of("priciest", "venue_name").alias("priciest_name"),
    )


def kpi_strips(fact: DataFrame, specs: Mapping[str, FilterSpec]) -> DataFrame:
    """(name, ...): the KPI strip of every context, one row each, as ``measures.kpis`` gives it for one.

    Four scans whatever the number of contexts: totals by area, costs, cuisine lists, and what orders the extremes. An empty
    context has zero counts and nulls.
    """
    rows = in_contexts(fact, list(specs.values()))
    areas = measures.area_totals(rows, "context").groupBy("context").agg(*measures.headline_columns())
    cuisines = rows.select("context", F.explode("cuisine_list").alias("cuisine")).distinct()
    parts = [
        areas,
        cost_quantiles(rows, {"median_cost": 0.5, "p90_cost": 0.9}),
        cuisines.groupBy("context").agg(F.count("cuisine").alias("cuisines")),
        extremes(rows),
    ]
    strips = names_of(fact, specs)
    for part in parts:
        # One row for each context at most.
        strips = strips.join(F.broadcast(part), "context", "left")
    figures = [field.rpartition(".")[2] for field in measures.STRIP]
    return strips.select(
        "name", *[F.coalesce(F.col(f), F.lit(0)).alias(f) if f in COUNTED else F.col(f) for f in figures]
    )
