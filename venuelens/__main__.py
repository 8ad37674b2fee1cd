"""spark-submit entry: python -m venuelens EXTRACT OUT [--multi-line]"""

from __future__ import annotations

import argparse

from venuelens import session
from venuelens.plans.batch import run


def main() -> None:
    parser = argparse.ArgumentParser(prog="venuelens", description="Build the star and all results.")
    parser.add_argument("extract", help="CSV file or folder of the raw extract")
    parser.add_argument("out", help="folder that all executors share")
    parser.add_argument(
        "--multi-line", action="store_true", help="allow line breaks inside quotes; one task per file"
    )
    options = parser.parse_args()
    spark = session.builder().getOrCreate()
    run(spark, options.extract, options.out, multi_line=options.multi_line)
    spark.stop()


if __name__ == "__main__":
    main()
