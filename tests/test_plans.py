"""Physical plans: what reaches the scan, what is shuffled, what never appears."""

import uuid

import pytest

from assayline import operators as op
from assayline.plans import backfill, registry
from assayline.schemas import BRONZE_EVENT, EVENT_PAIRS, SALES_PAIRS, SILVER_EVENT, SILVER_SALES
from assayline.sinks import Warehouse
from assayline.sources import read_bronze
from tests.helpers import edge_tables, plan_of, rows_of


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    bronze, products = edge_tables(spark)
    events, sales = op.silver_event(bronze), op.silver_sales(bronze, products)
    dated = bronze.selectExpr("*", "date(event_timestamp) as event_date")
    frames = []
    for spec, rows in ((BRONZE_EVENT, dated), (SILVER_EVENT, events), (SILVER_SALES, sales)):
        path = str(root / spec.name)
        rows.write.partitionBy(spec.partition).parquet(path)
        frames.append(spark.read.schema(spec.schema).parquet(path))
    bronze_table = read_bronze(spark, str(root / BRONZE_EVENT.name))
    return bronze_table, products, frames[1], frames[2]


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_silver_event_is_a_pruned_scan(stored):
    plan = plan_of(op.silver_event(stored[0], "2026-01-10"))
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(event_date" in plan
    assert "payment_method" not in plan and "In(action, [" in plan


def test_silver_sales_shuffles_no_records(stored):
    plan = plan_of(op.silver_sales(stored[0], stored[1], "2026-01-10"))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert "EqualTo(action,purchase)" in plan and "search_keyword" not in plan


def test_plain_counts_shuffle_groups_once(stored):
    plan = plan_of(op.gold_device(stored[2], "2026-01-10"))
    assert plan.count("Exchange") == 1 and "partial_count" in plan


@pytest.mark.parametrize("day", [None, "2026-01-10"])
def test_distinct_counts_hash_on_group_and_id(stored, day):
    assert "hashpartitioning(action" in plan_of(op.gold_funnel(stored[2], day))
    plan = plan_of(op.gold_sales_payment(stored[3], day))
    assert "hashpartitioning(payment_method" in plan and "order_id" in plan.split(
        "hashpartitioning(payment_method"
    )[-1].split(")")[0]
    assert "order_time" not in plan


def test_item_join_is_on_reduced_sides(stored, no_broadcast):
    plan = plan_of(op.gold_item(stored[2], stored[3], "2026-01-10"))
    join = plan[plan.index("SortMergeJoin") :]
    assert "HashAggregate(keys=[item_id" in join and "Inner" in join.splitlines()[0]
    assert "EqualTo(action,purchase)" in plan
    # Only the sales are read for all days.
    assert plan.count("PartitionFilters: [isnotnull(event_date") == 3


def test_a_day_of_items_does_not_shuffle_unreduced_sales(stored):
    plan = plan_of(op.gold_item(stored[2], stored[3], "2026-01-10"))
    above, below = plan.split(", LeftSemi, BuildRight")
    assert above.splitlines()[-1].lstrip(" :+-").startswith("BroadcastHashJoin [item_id")
    # Between the semi-join and the scan of the sales there is no exchange of them.
    sales = below[: below.index("FileScan")]
    assert "Exchange" not in sales and "total_amount" in sales


def test_a_day_of_items_reads_no_sales_of_other_days(spark, tmp_path, stored):
    bronze, products = edge_tables(spark)
    warehouse = Warehouse(spark, str(tmp_path), prefix=f"t_{uuid.uuid4().hex}")
    backfill(warehouse, bronze, products)
    tables = [warehouse.read(spec) for spec in (SILVER_EVENT, EVENT_PAIRS, SALES_PAIRS)]
    rows = op.gold_item_from_pairs(*tables, "2026-01-10")
    assert rows_of(rows) == rows_of(op.gold_item(stored[2], stored[3], "2026-01-10"))
    plan = plan_of(rows)
    assert "silver/sales/" not in plan and "silver/sales]" not in plan
    # All scans but that of the reduced sales pairs are of the one day.
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    whole = [line for line in scans if "PartitionFilters: []" in line]
    assert whole and all("sales_pairs" in line for line in whole)
    assert all("user_id" in line and "amount" in line for line in whole)


@pytest.mark.parametrize("name", ["event_pairs", "sales_pairs"])
def test_pairs_shuffle_reduced_rows_once(stored, name):
    plan = plan_of(getattr(op, name)(stored[2 if name == "event_pairs" else 3], "2026-01-10"))
    assert plan.count("Exchange") == 1 and "partial_" in plan.split("Exchange")[1]


@pytest.mark.parametrize("day", [None, "2026-01-10"])
def test_orders_are_reduced_before_they_meet(stored, no_broadcast, day):
    plan = plan_of(op.gold_item_by_order(stored[2], stored[3], day))
    join = plan[plan.index("SortMergeJoin") :]
    assert "order_id" in join.splitlines()[0] and "event_date" in join.splitlines()[0]
    assert "HashAggregate(keys=[event_id" in join or "HashAggregate(keys=[order_id" in join


LAZY = [
    name
    for name in registry.queries()
    if name.startswith(("silver_", "gold_")) and not name.endswith("_1d")
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    for never in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert never not in plan
