"""Compare every registered query with its oracle: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from harness import connect, difference, oracle_result, spark_result  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), entry.oracle_sql(), 0
    wanted = sys.argv[2:] or list(entry.queries())
    for name in wanted:
        started = time.time()
        try:
            actual = spark_result(entry.queries()[name](spark, sf_dir))
            problem = difference(actual, oracle_result(con, oracles[name])) if name in oracles else "no oracle"
            size = len(actual[1])
        except Exception as error:  # one broken query must not hide the others
            problem, size = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {size} rows {time.time() - started:.1f}s", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print(f"{len(wanted) - failed}/{len(wanted)} agree; oracles without query: {set(oracles) - set(entry.queries())}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
