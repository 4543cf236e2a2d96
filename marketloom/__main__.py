"""``spark-submit``-able daily run: ``python -m marketloom RAW_ROOT LAKE_ROOT``."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from marketloom.operators.dims import FIRST_DAY, LAST_DAY
from marketloom.operators.publish import DATABASE
from marketloom.plans import daily


def main() -> None:
    parser = argparse.ArgumentParser(prog="marketloom", description="Run the daily load.")
    parser.add_argument("raw_root", help="folder with the raw CSV files")
    parser.add_argument("lake_root", help="folder for the silver and gold tables")
    parser.add_argument(
        "--run-ts",
        type=datetime.fromisoformat,
        default=datetime.now().replace(microsecond=0),
        help="load time recorded in the tables",
    )
    parser.add_argument("--database", default=DATABASE, help="database of the published views")
    parser.add_argument("--first-day", type=date.fromisoformat, default=FIRST_DAY)
    parser.add_argument("--last-day", type=date.fromisoformat, default=LAST_DAY)
    options = parser.parse_args()
    spark = SparkSession.builder.appName("marketloom").getOrCreate()
    report = daily.run(
        spark,
        options.raw_root,
        options.lake_root,
        options.run_ts,
        database=options.database,
        first_day=options.first_day,
        last_day=options.last_day,
    )
    for table, rows in (report.silver_rows | report.gold_rows).items():
        print(f"{table}: {rows} rows")
    print("\n".join(report.checks))
    spark.stop()


if __name__ == "__main__":
    main()
