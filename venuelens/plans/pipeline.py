"""Raw rows to star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.config import COUNTRY_NAMES, CleaningRules
from venuelens.operators import cleaning, dimensions
from venuelens.sources.raw import SOURCE_ORDER
from venuelens.sources.star import Cleaned, Star, cleaned_from, read_star, write_star


def prepare(
    raw: DataFrame,
    rules: CleaningRules,
    countries: DataFrame | None = None,
    order: Sequence[str] = SOURCE_ORDER,
) -> DataFrame:
    """Trimmed, one row per venue, with its country and the number of its copies."""
    if countries is None:
        # Fifteen literal rows.
        countries = F.broadcast(
            dimensions.code_table(raw.sparkSession, COUNTRY_NAMES, "country_code", "country")
        )
    tidy = cleaning.trim_text(cleaning.normalise_names(raw))
    # The place in a file orders the copies, and nothing after that needs it.
    columns = [name for name in tidy.columns if name not in SOURCE_ORDER]
    kept = cleaning.keep_first_counted(tidy, "venue_id", order, "copies", columns)
    return cleaning.attach_country(kept, countries, rules.unknown_country)


def clean(
    raw: DataFrame,
    rules: CleaningRules = CleaningRules(),
    countries: DataFrame | None = None,
    order: Sequence[str] = SOURCE_ORDER,
) -> Cleaned:
    """The cleaned rows with their audit columns, lazily. ``order`` says which copy of a
    venue is the first."""
    width = len([name for name in raw.columns if name not in SOURCE_ORDER])
    return cleaned_from(prepare(raw, rules, countries, order), rules, width)


def build(raw: DataFrame, path: str, **options) -> Star:
    """Clean, write the star and read it back."""
    return read_star(raw.sparkSession, write_star(clean(raw, **options), path))
