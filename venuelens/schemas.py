"""Fixed schemas. Nothing in the engine infers a type from data."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The header contract of the raw extract, and the engine's name
# for each of its columns.
# ---------------------------------------------------------------------------
RAW_HEADER: dict[str, tuple[str, T.DataType]] = {
    "Restaurant ID": ("venue_id", T.LongType()),
    "Restaurant Name": ("venue_name", T.StringType()),
    "Country Code": ("country_code", T.IntegerType()),
    "City": ("city", T.StringType()),
    "Address": ("address", T.StringType()),
    "Locality": ("locality", T.StringType()),
    "Longitude": ("longitude", T.DoubleType()),
    "Latitude": ("latitude", T.DoubleType()),
    "Cuisines": ("cuisines", T.StringType()),
    "Average Cost for two": ("cost", T.DoubleType()),
    "Currency": ("currency", T.StringType()),
    "Has Table booking": ("has_booking", T.StringType()),
    "Has Online delivery": ("has_delivery", T.StringType()),
    "Is delivering now": ("delivering_now", T.StringType()),
    "Switch to order menu": ("switch_to_order_menu", T.StringType()),
    "Price range": ("price_range", T.IntegerType()),
    "Aggregate rating": ("rating", T.DoubleType()),
    "Rating text": ("rating_text", T.StringType()),
    "Votes": ("votes", T.LongType()),
}
# ---------------------------------------------------------------------------

RAW = T.StructType([T.StructField(name, kind) for name, kind in RAW_HEADER.values()])

FLAG_COLUMNS = ("has_booking", "has_delivery", "delivering_now", "switch_to_order_menu")

# The 27 columns of the fact table, then the parsed form of ``cuisines``: the
# distinct cuisines of the venue, which the bridge is an explode of.
FACT = T.StructType(
    [
        T.StructField("venue_id", T.LongType()),
        T.StructField("venue_name", T.StringType()),
        T.StructField("country_code", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("locality", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("geo_valid", T.BooleanType()),
        T.StructField("cuisines", T.StringType()),
        T.StructField("cuisine_count", T.IntegerType()),
        T.StructField("currency", T.StringType()),
        T.StructField("cost", T.DoubleType()),
        T.StructField("cost_band", T.StringType()),
        T.StructField("price_range", T.IntegerType()),
        T.StructField("price_label", T.StringType()),
        T.StructField("has_booking", T.BooleanType()),
        T.StructField("has_delivery", T.BooleanType()),
        T.StructField("delivering_now", T.BooleanType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("is_rated", T.BooleanType()),
        T.StructField("credible", T.BooleanType()),
        T.StructField("rating_text", T.StringType()),
        T.StructField("votes", T.LongType()),
        T.StructField("has_votes", T.BooleanType()),
        T.StructField("value_score", T.DoubleType()),
        T.StructField("cuisine_list", T.ArrayType(T.StringType())),
    ]
)

# The fact as it is written: behind its columns, what cleaning has to account for.
AUDITED = T.StructType(
    [
        *FACT.fields,
        T.StructField("copies", T.LongType()),
        T.StructField("rating_was_zero", T.BooleanType()),
        T.StructField("cost_was_void", T.BooleanType()),
        T.StructField("switch_to_order_menu", T.BooleanType()),
    ]
)

BRIDGE = T.StructType(
    [T.StructField("venue_id", T.LongType()), T.StructField("cuisine", T.StringType())]
)

DIM_COUNTRY = T.StructType(
    [
        T.StructField("country_code", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("venues", T.LongType()),
    ]
)

DIM_PRICE_RANGE = T.StructType(
    [T.StructField("price_range", T.IntegerType()), T.StructField("price_label", T.StringType())]
)

QUALITY_LOG = T.StructType(
    [
        T.StructField("step", T.StringType()),
        T.StructField("rows_affected", T.LongType()),
        T.StructField("detail", T.StringType()),
    ]
)
