"""Row-level expressions used by cleaning, filters and measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuelens.config import Bands

# Every character that counts as white space when text is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(text: Column) -> Column:
    """Strip all white space, not only the blank that ``trim`` knows."""
    return F.btrim(text, F.lit(WHITESPACE))


def yes_no(text: Column) -> Column:
    """Yes/no text of any case as a boolean; anything else is null."""
    word = F.lower(text)
    return F.when(word == "yes", True).when(word == "no", False)


def null_if_nan(number: Column) -> Column:
    return F.nanvl(number, F.lit(None).cast("double"))


def band(value: Column, bands: Bands) -> Column:
    """Label of the left-closed band ``value`` falls in; null outside all bands."""
    return _first_match(value, bands, bands.labels)


def band_index(value: Column, bands: Bands) -> Column:
    """1-based position of the band, for joining and sorting."""
    return _first_match(value, bands, range(1, len(bands.labels) + 1))


def _first_match(value, bands, results):
    matched = F.when(value < bands.edges[0], F.lit(None))
    for upper, result in zip(bands.edges[1:], results):
        inside = value.isNotNull() if upper is None else value < upper
        matched = matched.when(inside, F.lit(result))
    return matched


def band_sort_key(label: Column, bands: Bands) -> Column:
    """Ordinal of a band label; unknown or missing labels sort last, as 99."""
    return F.coalesce(lookup(label, {name: i for i, name in enumerate(bands.labels, 1)}), F.lit(99))


def lookup(key: Column, mapping: Mapping) -> Column:
    """A small fixed code table as one expression: no join, null when unmapped."""
    if not mapping:
        return F.lit(None)
    chain = None
    for code, value in mapping.items():
        hit = key == F.lit(code)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return chain


def tokens(text: Column) -> Column:
    """Non-empty trimmed items of a comma-separated list, duplicates kept."""
    return F.filter(F.transform(F.split(text, ","), trimmed), lambda item: item != "")


def geo_valid(latitude: Column, longitude: Column) -> Column:
    """In range and not the (0, 0) placeholder; missing coordinates are invalid."""
    in_range = latitude.between(-90, 90) & longitude.between(-180, 180)
    return F.coalesce(in_range & ~((latitude == 0) & (longitude == 0)), F.lit(False))


def value_per_hundred(rating: Column, cost: Column) -> Column:
    """Rating points bought by 100 units of cost."""
    return F.try_divide(rating, cost / 100)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, null on an empty denominator."""
    return F.try_divide(part * F.lit(100.0), whole)
