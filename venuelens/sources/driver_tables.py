"""The raw contract built from the TPC-H-like tables this repository is tested on.

An order is a venue, its customer gives the place and its lines give the rating,
the votes and the cuisines. The values are deliberately dirty (padded text, flag
words, 0 for unknown), so that cleaning has its work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.config import Bands, CleaningRules, Floors, Scope

# The scope, labels, bands and floors that suit these tables.
PRICE_LABELS = {1: "1-URGENT", 2: "2-HIGH", 3: "3-MEDIUM", 4: "4-NOT SPECIFIED", 5: "5-LOW"}
COST_BANDS = Bands(
    edges=(0, 50_000, 100_000, 200_000, 400_000, None),
    labels=("< 50k", "50k-100k", "100k-200k", "200k-400k", "400k+"),
)
TREND_BANDS = Bands(
    edges=(0, 50_000, 100_000, 150_000, 200_000, 250_000, 300_000, 400_000, None),
    labels=("<50k", "50k-100k", "100k-150k", "150k-200k", "200k-250k", "250k-300k", "300k-400k", "400k+"),
)
SCOPE = Scope(home_country="ASIA", home_currency="ASIA", metro_cities=("NATION_2", "NATION_7"))
FLOORS = Floors(votes=50, city=620, cuisine=450, locality=120)
RULES = CleaningRules(scope=SCOPE, floors=FLOORS, price_labels=PRICE_LABELS, cost_bands=COST_BANDS)

# The columns read, with their types, so that nothing is inferred.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_brand string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_quantity double, l_discount double, "
    "l_returnflag string",
    "events": "event_id long, user_id long, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: rating, votes, booking flag and cuisine text from its lines.

    The cuisines are the distinct (brand, return flag) pairs of the order, so an
    order keeps at most brands x flags entries however many lines it has, and the
    set is merged map-side: a hot order arrives as one small set per task.
    """
    brand = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").join(brand, F.col("l_partkey") == F.col("p_partkey"), "left")
    flag = F.col("l_returnflag")
    served = F.when(F.col("p_brand").isNotNull(), F.struct("p_brand", "l_returnflag"))
    totals = lines.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("votes"),
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("points"),
        F.count(F.lit(1)).alias("lines"),
        F.max(F.coalesce(flag == "R", F.lit(False))).alias("is_rated"),
        F.max(F.coalesce(flag == "A", F.lit(False))).alias("booked"),
        F.sort_array(F.collect_set(served)).alias("served"),
    )
    # Whole points over whole counts: the same rating whatever the order of the lines.
    rating = F.when(F.col("is_rated"), F.col("points") / (F.col("lines") * 2.0)).otherwise(0.0)
    return totals.select(
        F.col("l_orderkey").alias("venue_id"),
        rating.alias("rating"),
        "votes",
        "booked",
        F.nullif(F.concat_ws(" , ", F.col("served.p_brand")), F.lit("")).alias("cuisines"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return region.select(
        F.col("r_regionkey").cast("int").alias("country_code"), F.col("r_name").alias("country")
    )


def raw_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under the raw contract. An order without a known customer, nation or region
    is a venue with gaps, which cleaning counts. The lines join comes last: its result is
    already partitioned by venue, which de-duplication needs. Texts are put together after it,
    so that their parts are shuffled once."""
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    orders = table(spark, sf_dir, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"), "left")
    measured = orders.join(line_measures(spark, sf_dir), F.col("o_orderkey") == F.col("venue_id"), "left")
    status = F.col("o_orderstatus")
    return measured.select(
        F.col("o_orderkey").alias("venue_id"),
        F.concat(F.lit(" "), "c_name").alias("venue_name"),
        F.col("n_regionkey").cast("int").alias("country_code"),
        F.concat("n_name", F.lit("  ")).alias("city"),
        F.concat(F.lit("\t"), "c_mktsegment", F.lit(" ")).alias("locality"),
        F.concat_ws(", ", "c_mktsegment", "n_name", "r_name").alias("address"),
        (F.col("c_custkey") % 400 - 200).cast("double").alias("longitude"),
        (F.col("c_acctbal") / 100).alias("latitude"),
        F.col("r_name").alias("currency"),
        # The price of a pending order is not known yet.
        F.when(status == "P", F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("cost"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("price_range"),
        F.when(status == "O", "YES").otherwise("no").alias("has_delivery"),
        F.when(status == "P", "Yes").when(status == "F", "No").otherwise("maybe").alias("delivering_now"),
        F.lit("No").alias("switch_to_order_menu"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
        F.coalesce("votes", F.lit(0)).alias("votes"),
        F.when(F.col("booked"), "Yes").otherwise("No").alias("has_booking"),
        F.lit("Scored").alias("rating_text"),
        "cuisines",
    )


def repeated_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw venues, those rated 2 or more listed twice, the later listing with votes added.
    ``listing`` is the place in the extract: with the venue id it orders copies totally.
    Venues of the third region have a country code that no name belongs to."""
    venues = raw_venues(spark, sf_dir)
    times = F.when(F.col("rating") >= 2, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return venues.withColumns(
        {
            "country_code": F.when(F.col("country_code") == 2, F.lit(99)).otherwise(F.col("country_code")),
            "listing": F.explode(times),
        }
    ).withColumn("votes", F.col("votes") + (F.col("listing") - 1) * 1_000)
