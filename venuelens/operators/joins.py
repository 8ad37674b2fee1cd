"""Joins along the star. Spark chooses their strategy by the sizes it knows or finds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def star_join(
    fact: DataFrame, bridge: DataFrame, countries: DataFrame, tiers: DataFrame
) -> DataFrame:
    """Fact at venue-cuisine grain with the names its dimensions give it.

    The bridge and the fact meet on the venue id, of which the fact has one row each;
    the dimensions are small files that Spark broadcasts by their size. A code with
    several currencies is in the country table once for each, and is one name here.
    """
    coded = fact.drop("country", "price_label")
    names = countries.select("country_code", "country").distinct()
    return (
        bridge.join(coded, "venue_id")
        .join(names, "country_code", "left")
        .join(tiers.select("price_range", "price_label"), "price_range", "left")
    )
