"""Command line for spark-submit or `python -m assayline`: land, compact, day, days, refresh, backfill."""

from __future__ import annotations

import argparse
import sys

from assayline.functions import days_between, target_day
from assayline.plans import backfill, refresh, run_day, run_days
from assayline.session import build_session
from assayline.sinks import Warehouse
from assayline.sources import read_bronze, read_products
from assayline.streaming import compact, land_stream
from assayline.streaming.landing import BUCKETS


def parse(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="assayline")
    commands = parser.add_subparsers(dest="command", required=True)

    land = commands.add_parser("land", help="land newly arrived JSON records, each once")
    land.add_argument("--source", required=True)
    land.add_argument("--bronze", required=True)
    land.add_argument("--state", required=True, help="checkpoint folder")
    land.add_argument("--rejects", help="set malformed lines aside here instead of failing")
    land.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a new bronze folder")
    land.add_argument("--max-bytes", type=int, help="bound of one micro-batch")

    compacted = commands.add_parser("compact", help="one file a bucket in days with many files")
    compacted.add_argument("--bronze", required=True)
    compacted.add_argument("--most", type=int, default=8, help="files a bucket that a day may have")

    for name, text in (
        ("day", "replace one day"),
        ("days", "replace the days from the first to the last"),
        ("refresh", "replace what records landed since the last refresh have changed"),
        ("backfill", "replace all days"),
    ):
        command = commands.add_parser(name, help=f"{text} in all tables")
        command.add_argument("--bronze", required=True, nargs="+", help="landed folders")
        command.add_argument("--bronze-sales", nargs="+", help="landed folders of the sales, if apart")
        command.add_argument("--products", required=True, help="product master CSV")
        command.add_argument("--warehouse", required=True, help="root folder of the tables")
        command.add_argument("--prefix", default="shop", help="database name prefix")
        if name == "day":
            which = command.add_mutually_exclusive_group(required=True)
            which.add_argument("--day", help="the day to load")
            which.add_argument("--run-date", help="logical run date; loads the day before")
        if name == "days":
            command.add_argument("--first", required=True)
            command.add_argument("--last", required=True)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> int:
    given = parse(arguments)
    spark = build_session(f"assayline-{given.command}")
    if given.command == "land":
        land_stream(
            spark,
            given.source,
            given.bronze,
            given.state,
            max_bytes=given.max_bytes,
            rejects_path=given.rejects,
            buckets=given.buckets,
        )
        return 0
    if given.command == "compact":
        compact(spark, given.bronze, most=given.most)
        return 0
    warehouse = Warehouse(spark, given.warehouse, given.prefix)
    days = None
    if given.command == "day":
        days = given.day or target_day(given.run_date)
    elif given.command == "days":
        days = days_between(given.first, given.last)
    bronze = read_bronze(spark, *given.bronze, day=days)
    orders = read_bronze(spark, *given.bronze_sales, day=days) if given.bronze_sales else None
    products = read_products(spark, given.products)
    if given.command == "backfill":
        backfill(warehouse, bronze, products, sales_bronze=orders)
    elif given.command == "day":
        run_day(warehouse, bronze, products, days, sales_bronze=orders)
    elif given.command == "days":
        run_days(warehouse, bronze, products, given.first, given.last, sales_bronze=orders)
    else:
        paths = [*given.bronze, *(given.bronze_sales or [])]
        refresh(warehouse, bronze, products, paths, sales_bronze=orders)
    return 0


if __name__ == "__main__":
    sys.exit(main())
