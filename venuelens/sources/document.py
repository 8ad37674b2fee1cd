"""All results of one scope as a nested JSON document.

The document holds the parts whose size does not depend on the data: figures,
bands, tiers and top-k tables. The parts that grow with it (every benchmarked
city, every scored locality) are written beside it as JSON lines.

Blanks are written as null. Figures are rounded here and nowhere else, half to even.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.config import RATING_BANDS, TREND_BANDS, Bands, CleaningRules
from venuelens.functions.statistics import adjusted_skewness
from venuelens.operators import filters, measures, opportunity, ranking
from venuelens.operators.measures import only_row
from venuelens.operators.rollup import Summary, summarise

KEEP_NULLS = {"ignoreNullFields": "false"}

# Decimal places of each rounded field; 2 where none is given.
PLACES = {
    "avg_cost": 0, "median_cost": 0, "p90_cost": 0, "max_cost": 0, "avg_votes": 0,
    "votes_per_venue": 0, "not_rated_pct": 1, "delivery_pct": 1, "booking_pct": 1, "share_pct": 1,
    "metro_pct": 1, "top3_share_pct": 1, "single_cuisine_pct": 1, "budget_pct": 1,
    "pearson_cost": 3, "pearson_votes": 3, "spearman": 3,
}


def presented(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """The wanted fields, doubles rounded to their places."""
    kinds = dict(df.dtypes)
    columns = [
        F.bround(F.col(name), PLACES.get(name, 2)).alias(name) if kinds[name] == "double" else F.col(name)
        for name in (fields or df.columns)
    ]
    return df.select(*columns)


BOARD = ["venue_name", "city", "locality", "cuisines", "cost", "rating", "votes"]
POINT = ["venue_name", "city", "cost", "rating", "votes", "price_label"]
PLACE = ["city", "locality", "restaurants", "avg_rating", "avg_cost", "votes_per_venue", "score"]
CUISINE = ["cuisine", "restaurants", "avg_rating", "avg_cost", "total_votes", "delivery_pct"]
MEASURED = {"cost", "rating", "avg_rating", "avg_cost", "votes_per_venue", "score", "delivery_pct"}


def _record(fields: Sequence[str]) -> str:
    """A struct of fields, measures rounded to their places."""
    shown = [f"bround({name}, {PLACES.get(name, 2)}) AS {name}" if name in MEASURED else name for name in fields]
    return f"struct({', '.join(shown)})"


def _list(fields: Sequence[str], order: str, where: str = "true") -> str:
    """A table of bounded size as one ordered array of records."""
    entries = f"collect_list(struct({order}, {_record(fields)} AS record)) FILTER (WHERE {where})"
    return f"transform(array_sort({entries}), entry -> entry.record)"


def _texts(values: Sequence[str]) -> str:
    """Literal texts; braces are doubled, as the statement is formatted with its tables."""
    quoted = [repr(str(v)).replace("{", "{{").replace("}", "}}") for v in values]
    return f"array({', '.join(quoted)})"


def charts_sql(labels: Mapping[int, str], rating_bands: Bands, trend_bands: Bands, cuisine_floor: int) -> str:
    """One row (charts, tables) over the tables of a summary.

    Bands, tiers and delivery are one pass of grouping sets over the cells. All boards are one pass over theirs.
    """
    mean = "try_divide(sum({0}), sum({1}))".format
    sums = f"""sum(venues) AS restaurants, bround({mean("rating", "ratings")}, 2) AS avg_rating,
        bround({mean("cost", "costed")}, 0) AS avg_cost, bround({mean("votes", "voted")}, 0) AS avg_votes,
        bround({mean("delivery", "delivery_known")} * 100, 1) AS delivery_pct,
        bround({mean("booking", "booking_known")} * 100, 1) AS booking_pct"""

    def by(key: str) -> str:
        entry = "struct(restaurants, avg_rating, avg_cost, avg_votes, delivery_pct, booking_pct)"
        found = f"collect_list(struct({key}, {entry})) FILTER (WHERE of = '{key}' AND {key} IS NOT NULL)"
        return f"map_from_entries({found}) AS by_{key}"

    def banded(bands: Bands, key: str, *fields: str) -> str:
        found = f"try_element_at(by_{key}, i + 1)"
        more = "".join(f"{found}.{name} AS {name}, " for name in fields)
        return f"transform({_texts(bands.labels)}, (band, i) -> struct(band, {more}coalesce({found}.restaurants, 0L) AS restaurants))"

    tier = "try_element_at(by_price_label, label)"
    tiers = f"""transform(filter({_texts([v for _, v in sorted(labels.items())])}, label -> {tier} IS NOT NULL), label -> struct(
        label AS price_label, {tier}.restaurants AS restaurants,
        bround(100.0D * {tier}.restaurants / venues, 1) AS share_pct,
        {", ".join(f"{tier}.{name} AS {name}" for name in ("avg_rating", "avg_cost", "delivery_pct", "booking_pct", "avg_votes"))}))"""
    delivery = f"""transform(filter(array(false, true), flag -> try_element_at(by_has_delivery, flag) IS NOT NULL),
        flag -> struct(flag AS has_delivery, {", ".join(f"try_element_at(by_has_delivery, flag).{name} AS {name}" for name in ("restaurants", "avg_rating", "avg_votes", "avg_cost"))}))"""
    keys = ["rating_position", "trend_position", "price_label", "has_delivery"]
    of = " ".join(f"WHEN grouping({key}) = 0 THEN '{key}'" for key in keys)
    boards = [_list(BOARD, "place", f"board = '{name}'") + f" AS {name}" for name in ("top_rated", "most_expensive", "best_value", "most_voted")]
    return f"""
WITH grouped AS (
  SELECT {", ".join(keys)}, CASE {of} END AS of, {sums}
  FROM {{cells}} GROUP BY GROUPING SETS ({", ".join(f"({key})" for key in keys)})
), maps AS (
  SELECT {", ".join(map(by, keys))}, sum(restaurants) FILTER (WHERE of = 'price_label') AS venues FROM grouped
), banded AS (
  SELECT {banded(rating_bands, "rating_position")} AS rating_distribution, {tiers} AS price_range_mix,
    {banded(trend_bands, "trend_position", "avg_rating")} AS cost_band_rating_trend, {delivery} AS delivery_effect
  FROM maps
), cities AS (
  SELECT city, sum(venues) AS restaurants FROM {{cells}} WHERE city IS NOT NULL
  GROUP BY city ORDER BY restaurants DESC, city LIMIT 15
), volume AS (
  SELECT * FROM {{cuisines}} ORDER BY restaurants DESC, cuisine LIMIT 15
), best AS (
  SELECT * FROM {{cuisines}} WHERE restaurants >= {cuisine_floor} AND avg_rating IS NOT NULL
  ORDER BY round(avg_rating, 9) DESC, cuisine LIMIT 12
), shown AS (
  SELECT *, (SELECT struct({", ".join(boards)}, {_list(POINT, "venue_id", "board = 'cost_vs_rating'")} AS cost_vs_rating)
             FROM {{boards}}) AS boards
  FROM banded
)
SELECT struct(
    rating_distribution, price_range_mix,
    (SELECT {_list(["city", "restaurants"], "-restaurants AS n, city")} FROM cities) AS city_all,
    (SELECT {_list(CUISINE, "-restaurants AS n, cuisine")} FROM volume) AS cuisine_by_volume,
    (SELECT {_list(CUISINE[:4], "-round(avg_rating, 9) AS r, cuisine")} FROM best) AS cuisine_by_rating,
    boards.cost_vs_rating, cost_band_rating_trend, delivery_effect
  ) AS charts,
  struct(
    boards.top_rated, boards.most_expensive, boards.best_value, boards.most_voted,
    (SELECT {_list(PLACE, "score IS NULL AS blank, -round(score, 9) AS s, city, locality")} FROM {{places}}) AS opportunity
  ) AS tables
FROM shown
"""


def kpi_section(scope: Summary, once: Column) -> DataFrame:
    """The KPI strip with the skewness and the rating bias, rounded."""
    strip = scope.kpis().withColumn("once", once)
    rounded = presented(strip.select("*", "once.cost_skew", "once.naive_rating").drop("once"))
    # The difference of the two figures as they are shown.
    return rounded.withColumn("bias_avoided", F.bround(F.col("avg_rating") - F.col("naive_rating"), 2))


def stats_section(scope: Summary, once: Column) -> DataFrame:
    parts = scope.fact.sparkSession.range(0, 1, 1, 1).select(
        once.alias("once"),
        only_row(scope.spearman()).alias("ranks"),
        only_row(scope.top_cuisine_share(3)).alias("top3"),
    )
    return presented(
        parts.select(
            "once.pearson_cost",
            "ranks.spearman",
            "once.pearson_votes",
            "once.n_for_correlation",
            "once.rating_gap",
            "once.welch_t",
            "once.n_yes",
            "once.n_no",
            "once.metro_pct",
            "once.single_cuisine_pct",
            F.col("top3.cuisines").alias("top3_cuisines"),
            F.col("top3.share_pct").alias("top3_share_pct"),
        )
    )


def kpi_document(
    fact: DataFrame,
    rules: CleaningRules = CleaningRules(),
    trend_bands: Bands = TREND_BANDS,
    rating_bands: Bands = RATING_BANDS,
    max_point_cost: float = 4000,
) -> DataFrame:
    """One row with the nested result of the home scope: meta, kpi, charts, tables, stats.

    The home scope is reduced once to small written tables (``rollup.summarise``), which this call runs;
    what they cannot give (central moments, the top cuisines' share, the whole data set's size) is one scan each.
    """
    home = filters.in_country(fact, rules.scope.home_country)
    floors = rules.floors
    scope = summarise(home, ranking.standard_boards(max_point_cost), rating_bands, trend_bands)
    # The figures that need nothing but the home rows, in one pass.
    once = only_row(
        home.agg(
            measures.venue_count().alias("rows_home"),
            adjusted_skewness(F.col("cost")).alias("cost_skew"),
            F.avg(F.coalesce("rating", F.lit(0.0))).alias("naive_rating"),
            *measures.correlation_columns("n_for_correlation"),
            *measures.delivery_difference_columns(),
            *measures.share_columns(rules.scope.metro_cities),
        )
    )
    meta = measures.dataset_facts(fact).withColumnRenamed("cities", "cities_global").withColumns(
        {
            "rows_home": once["rows_home"],
            "min_votes_for_leaderboard": F.lit(floors.votes),
        }
    )
    best = opportunity.shortlist(opportunity.score(scope.localities(floors.locality), keep_unrated=True))
    parts = fact.sparkSession.sql(
        charts_sql(rules.price_labels, rating_bands, trend_bands, floors.cuisine),
        cells=scope.cells, cuisines=scope.cuisines, boards=scope.boards, places=best,
    )
    return parts.select(
        only_row(meta).alias("meta"),
        only_row(kpi_section(scope, once)).alias("kpi"),
        "charts",
        "tables",
        only_row(stats_section(scope, once)).alias("stats"),
    )


def as_json(document: DataFrame) -> DataFrame:
    """The document as one row of JSON text."""
    return document.select(F.to_json(F.struct(*document.columns), KEEP_NULLS).alias("value"))


def read_back(text: DataFrame, schema: T.StructType) -> DataFrame:
    """The document's JSON text as one row per figure: (section, place, field, number, text).

    Places count the entries of a list; a section of single figures has place 0.
    """

    def entries(section: str, place: str, record: str, fields: T.StructType) -> str:
        return ", ".join(
            f"named_struct('section', '{section}', 'place', cast({place} as int), 'field', '{field.name}', "
            + (
                f"'number', cast({record}.{field.name} as double), 'text', cast(null as string))"
                if isinstance(field.dataType, T.NumericType)
                else f"'number', cast(null as double), 'text', cast({record}.{field.name} as string))"
            )
            for field in fields
        )

    single, listed = [], []
    for part in schema:
        if part.name in ("charts", "tables"):
            for chart in part.dataType:
                rows = entries(chart.name, "place", "entry", chart.dataType.elementType)
                column = f"coalesce(document.{part.name}.{chart.name}, array())"
                listed.append(f"flatten(transform({column}, (entry, place) -> array({rows})))")
        else:
            single.append(entries(part.name, "0", f"document.{part.name}", part.dataType))
    # One text instead of a call for each of some hundred fields.
    every = F.expr(f"concat(array({', '.join(single)}), {', '.join(listed)})")
    parsed = text.select(F.from_json("value", schema).alias("document"))
    return parsed.select(F.inline(every))


def growing_charts(fact: DataFrame, rules: CleaningRules = CleaningRules()) -> dict[str, DataFrame]:
    """The tables of the document whose length follows the data."""
    home = filters.in_country(fact, rules.scope.home_country)
    scored = opportunity.opportunity(home, rules.floors.locality, keep_unrated=True)
    return {
        "city_benchmark": presented(measures.city_summary(home, rules.floors.city)),
        "country_overview": presented(measures.country_overview(fact)),
        "opportunity_quadrant": presented(
            scored, ["locality", "city", "restaurants", "avg_rating", "votes_per_venue", "score"]
        ),
    }


def write_document(document: DataFrame, charts: Mapping[str, DataFrame], path: str) -> None:
    as_json(document).write.mode("overwrite").text(f"{path}/kpis")
    for name, chart in charts.items():
        chart.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/charts/{name}")
