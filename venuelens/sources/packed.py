"""Compact rows for export: dictionary codes, 0/1 flags and cuisine code lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.operators.dimensions import dictionaries, dictionary_of, encode, encode_list


@dataclass(frozen=True)
class Packed:
    rows: DataFrame
    cities: DataFrame
    localities: DataFrame
    cuisines: DataFrame


def packed_rows(fact: DataFrame) -> Packed:
    """Ten fields per venue, with the three dictionaries they refer to."""
    pairs = fact.select(F.explode("cuisine_list").alias("cuisine"))
    codes = dictionaries([(fact, ["city", "locality"]), (pairs, ["cuisine"])])
    cities, localities, cuisines = (dictionary_of(codes, name) for name in ("city", "locality", "cuisine"))
    coded = encode(encode(fact, "city", cities, "city_code"), "locality", localities, "locality_code")
    listed = encode_list(coded, "venue_id", "cuisine_list", cuisines, "cuisine_codes")
    rows = listed.select(
        F.col("venue_name").alias("name"),
        "city_code",
        "locality_code",
        # Whole cost and one-digit rating, as the export format has them.
        F.col("cost").cast("long").alias("cost"),
        F.bround("rating", 1).alias("rating"),
        "votes",
        "price_range",
        F.coalesce(F.col("has_delivery").cast("int"), F.lit(0)).alias("delivery"),
        F.coalesce(F.col("has_booking").cast("int"), F.lit(0)).alias("booking"),
        "cuisine_codes",
    )
    return Packed(rows, cities, localities, cuisines)


def write_packed(packed: Packed, path: str) -> None:
    """JSON lines: the rows, and one file set per dictionary."""
    for name in ("rows", "cities", "localities", "cuisines"):
        getattr(packed, name).write.mode("overwrite").json(f"{path}/{name}")
