"""Command line: ``python -m tallyloom all --warehouse DIR --raw 2023_2024=DIR ...``."""

from __future__ import annotations

import argparse

from tallyloom.catalog.editions import EDITIONS
from tallyloom.plans.run import SILVER_TABLE, run_bronze, run_charts, run_gold, run_silver
from tallyloom.session import build_session

RECORD_ENDS = {"crlf": "\r\n", "lf": "\n"}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyloom", description="Survey analytics as Spark jobs.")
    parser.add_argument("layer", choices=["bronze", "silver", "gold", "charts", "all"])
    parser.add_argument("--warehouse", required=True, help="folder for all layers, reachable by every executor")
    parser.add_argument("--raw", action="append", default=[], metavar="EDITION=DIR", help="CSV folder of an edition")
    parser.add_argument("--clean-names", action="store_true", help="land cleaned column names instead of raw ones")
    parser.add_argument("--gate", action="store_true", help="stop when a quality rule fails")
    parser.add_argument("--dedupe", action="store_true", help="drop rows that repeat another in every column")
    parser.add_argument("--record-end", choices=RECORD_ENDS, help="line break found at record ends only: files are split")
    parser.add_argument("--fold-labels", action="store_true", help="fold drifted wording before the questions, not after")
    parser.add_argument("--silver-table", default=SILVER_TABLE, help="catalog name of the unified table")
    parser.add_argument("--master", help="Spark master; by default the one spark-submit sets")
    options = parser.parse_args(arguments)

    folders = dict(entry.split("=", 1) for entry in options.raw)
    unknown = sorted(set(folders) - set(EDITIONS))
    if unknown:
        parser.error(f"unknown edition {', '.join(unknown)}; known: {', '.join(EDITIONS)}")
    spark = build_session(master=options.master)
    warehouse = options.warehouse.rstrip("/")

    if options.layer in ("bronze", "all"):
        if not folders:
            parser.error("landing needs --raw EDITION=DIR")
        record_end = RECORD_ENDS.get(options.record_end)
        run_bronze(spark, folders, warehouse, options.clean_names, options.gate, record_end, options.dedupe).show(truncate=False)
    if options.layer in ("silver", "all"):
        run_silver(spark, warehouse, options.silver_table)
    if options.layer in ("gold", "all"):
        run_gold(spark, warehouse, options.fold_labels, options.silver_table)
    if options.layer in ("charts", "all"):
        run_charts(spark, warehouse)


if __name__ == "__main__":
    main()
