"""Time the pipeline's queries over stored tables; print one JSON line.

Preparation, not timed: the supplied tables become a landed record table, a product master
and, for the sales KPIs, the large line-level sales table. Every timed query then reads
stored Parquet in full and writes to Spark's no-op sink. Beside the queries the real path is
timed once each: landing, a backfill of all tables and one daily run. `sales_grouping_sets`
is the comparison of the six sales tables in one pass over GROUPING SETS.
"""

from __future__ import annotations

import json
import os
import sys
import time

from assayline import operators as op, schemas as s
from assayline.plans import backfill, run_day
from assayline.plans.registry import DAY
from assayline.session import build_session, scratch_path
from assayline.sinks import Warehouse
from assayline.sources import read_bronze, testdata, write_records
from assayline.streaming import land_stream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def stored(spark, rows, root, spec):
    path = f"{root}/{spec.name}"
    rows.repartition(int(CPUS)).write.parquet(path)
    return spark.read.parquet(path)


def sales_grouping_sets(lines):
    """All six sales tables' measures in one pass, to compare with six separate ones."""
    lines.createOrReplaceTempView("bench_lines")
    keys = ("item_id", "category", "user_id", "payment_method", "region")
    sets = ", ".join(["(dt)"] + [f"(dt, {key})" for key in keys])
    return lines.sparkSession.sql(
        f"SELECT dt, {', '.join(keys)}, grouping_id() AS which, sum(total_amount) AS revenue, "
        "count(total_amount) AS priced, count(DISTINCT order_id) AS orders, "
        "count(DISTINCT user_id) AS users, sum(quantity) AS quantity "
        f"FROM bench_lines GROUP BY GROUPING SETS ({sets})"
    )


def real_path(spark, root, bronze, products):
    """Seconds of one landing, one backfill and one daily run, writes included."""
    took = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        took[name] = time.perf_counter() - start

    write_records(bronze, f"{root}/raw")
    timed("land", lambda: land_stream(spark, f"{root}/raw", f"{root}/landed", f"{root}/state"))
    landed = read_bronze(spark, f"{root}/landed")
    warehouse = Warehouse(spark, f"{root}/warehouse", prefix="bench")
    timed("backfill", lambda: backfill(warehouse, landed, products))
    one_day = read_bronze(spark, f"{root}/landed", day=DAY)
    timed("daily_run", lambda: run_day(warehouse, one_day, products, DAY))
    return took


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.log.level": "ERROR",
        },
    )
    root = scratch_path(spark, "bench")
    bronze = stored(spark, testdata.bronze_from_events(spark, SF_DIR), root, s.BRONZE_EVENT)
    products = testdata.products_from_part(spark, SF_DIR)
    events = stored(spark, op.silver_event(bronze), root, s.SILVER_EVENT)
    sales = stored(spark, op.silver_sales(bronze, products), f"{root}/events", s.SILVER_SALES)
    lines = stored(
        spark, testdata.sales_from_lineitem(spark, SF_DIR), f"{root}/lines", s.SILVER_SALES
    )
    queries = {
        "silver_event": lambda: op.silver_event(bronze),
        "silver_sales": lambda: op.silver_sales(bronze, products),
        "gold_funnel": lambda: op.gold_funnel(events),
        "gold_device": lambda: op.gold_device(events),
        "gold_search": lambda: op.gold_search(events),
        "gold_campaign": lambda: op.gold_campaign(events),
        "gold_item": lambda: op.gold_item(events, sales),
        "gold_item_by_order": lambda: op.gold_item_by_order(events, sales),
        "gold_sales_daily": lambda: op.gold_sales_daily(lines),
        "gold_sales_product": lambda: op.gold_sales_product(lines),
        "gold_sales_category": lambda: op.gold_sales_category(lines),
        "gold_sales_user": lambda: op.gold_sales_user(lines),
        "gold_sales_payment": lambda: op.gold_sales_payment(lines),
        "gold_sales_region": lambda: op.gold_sales_region(lines),
    }
    compared = {"sales_grouping_sets": lambda: sales_grouping_sets(lines)}
    best: dict[str, float] = {}
    for _ in range(RUNS + 1):  # the first round warms up and counts only if it is the fastest
        for name, query in {**queries, **compared}.items():
            start = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best[name] = min(took, best.get(name, took))
    best |= real_path(spark, root, bronze, products)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "pipeline_queries_total",
                "value": round(sum(best[name] for name in queries), 3),
                "unit": "sec",
                "queries": {name: round(took, 3) for name, took in best.items()},
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
