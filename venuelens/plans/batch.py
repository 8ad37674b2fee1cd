"""The batch run: raw extract to star, aggregates, document and packed rows."""

from __future__ import annotations

from pyspark.sql import SparkSession

from venuelens.config import CleaningRules
from venuelens.plans.pipeline import build
from venuelens.sources import document, packed, raw, star


def run(
    spark: SparkSession,
    extract: str,
    out: str,
    rules: CleaningRules = CleaningRules(),
    multi_line: bool = False,
) -> star.Star:
    """Everything the engine publishes, under ``out``; the raw file is cleaned once and
    all results start from the written star."""
    model = build(raw.read_raw(spark, extract, multi_line=multi_line), f"{out}/star", rules=rules)
    home, _ = star.load_model(spark, f"{out}/star", rules.scope)
    tables = star.aggregates(home, dict(rules.price_labels), rules.floors)
    star.write_aggregates(tables, f"{out}/aggregates", csv=True)
    document.write_document(
        document.kpi_document(model.fact, rules),
        document.growing_charts(model.fact, rules),
        f"{out}/document",
    )
    packed.write_packed(packed.packed_rows(home), f"{out}/packed")
    return model
