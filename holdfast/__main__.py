"""``python -m holdfast DATA OUT``: run the churn study over a folder of order tables."""

from __future__ import annotations

import argparse

from holdfast.operators.models import SEARCH_SPACE
from holdfast.plans.run import run_study
from holdfast.session import build_session
from holdfast.sources import load
from holdfast.sources.schemas import FEATURE_SETS

NEEDED = ("orders", "order_items", "order_reviews", "customers", "products")


def main() -> None:
    parser = argparse.ArgumentParser(prog="holdfast", description=__doc__)
    parser.add_argument("data", help="folder with one file or folder per table")
    parser.add_argument("out", help="folder for the results")
    parser.add_argument("--format", default="csv", help="csv, parquet or another Spark source")
    parser.add_argument("--pattern", help="file name with {table} in place of the table's name")
    parser.add_argument("--lenient", action="store_true", help="malformed values become null")
    parser.add_argument("--feature-set", choices=sorted(FEATURE_SETS), default="core9")
    parser.add_argument("--fill", choices=("literal", "repaired"), default="literal")
    parser.add_argument("--draws", type=int, default=30, help="draws of the random search")
    parser.add_argument("--folds", type=int, default=5)
    options = parser.parse_args()
    spark = build_session()
    tables = load(spark, options.data, options.format, options.pattern, NEEDED, options.lenient)
    paths = run_study(
        spark, tables, options.out, options.feature_set, options.fill, SEARCH_SPACE, options.draws, options.folds
    )
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
