"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query is run once
to warm up and then three times; its figure is the median. Cached tables are dropped
before each run, so a run does all of its work. Building the star from the driver
tables is timed once, as it is done once per data set.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from venuelens import session  # noqa: E402
from venuelens.plans import registry  # noqa: E402

HEADLINE = [
    "clean_fact", "quality_log", "bridge_pairs", "packed_rows", "filter_all", "filter_search",
    "filter_tag_semi_join", "kpis", "kpis_filtered", "cost_skew", "rating_histogram",
    "tier_summary", "city_benchmark", "tag_summary", "tag_summary_join", "tags_by_rating",
    "cost_band_trend", "country_overview", "facets", "top3_tag_share", "star_join",
    "correlations", "spearman", "welch_t", "top_rated", "best_value", "dense_ranks",
    "scatter_sample", "opportunity_scores", "shortlist", "invariants", "star_filter", "dict_codes",
    "kpi_document",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        session.builder("venuelens-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        spark.catalog.clearCache()
        started = time.perf_counter()
        registry.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    started = time.perf_counter()
    registry.built_star(spark, sf_dir)
    seconds = {"build_star": round(time.perf_counter() - started, 3)}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds, star build plus median warm run of each headline query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
