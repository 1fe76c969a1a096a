"""Partition replacement: repeatable, empty means empty, other days stay."""

import os
import uuid
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from assayline import operators as op
from assayline.functions import target_day
from assayline.plans import backfill, refresh, run_day, run_days
from assayline.schemas import BRONZE, GOLD_ITEM, PIPELINE_TABLES, SILVER_EVENT, SILVER_SALES
from assayline.sinks import Warehouse
from assayline.sinks.warehouse import SchemaMismatch
from assayline.sources import read_bronze
from assayline.streaming import land_batch
from tests.helpers import bronze_of, edge_tables, plan_of, rows_of

JAN10, JAN11 = "2026-01-10", "2026-01-11"


def fresh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path), prefix=f"t_{uuid.uuid4().hex}")


def test_target_day():
    assert target_day("2026-01-12") == date(2026, 1, 11)
    assert target_day(date(2026, 3, 1)) == date(2026, 2, 28)


def test_days_equal_backfill_and_repeat(spark, tmp_path):
    bronze, products = edge_tables(spark)
    whole = fresh(spark, tmp_path / "whole")
    backfill(whole, bronze, products)
    daily = fresh(spark, tmp_path / "daily")
    for day in (JAN10, JAN11, JAN10):
        run_day(daily, bronze, products, day)
    for spec in PIPELINE_TABLES:
        expected = rows_of(whole.read(spec))
        assert expected and rows_of(daily.read(spec)) == expected, spec.name
        assert whole.read(spec).columns == spec.columns


def events_table(spark, tmp_path):
    warehouse = fresh(spark, tmp_path)
    warehouse.create(SILVER_EVENT)
    bronze, _ = edge_tables(spark)
    warehouse.replace_all(SILVER_EVENT, op.silver_event(bronze))
    return warehouse, bronze


def test_past_item_day_follows_loaded_sales(spark, tmp_path):
    bronze, products = edge_tables(spark)
    warehouse = fresh(spark, tmp_path)
    for spec in (SILVER_EVENT, SILVER_SALES, GOLD_ITEM):
        warehouse.create(spec)

    def revenue_after_loading(day):
        warehouse.replace_day(SILVER_EVENT, op.silver_event(bronze, day), day)
        warehouse.replace_day(SILVER_SALES, op.silver_sales(bronze, products, day), day)
        items = op.gold_item(warehouse.read(SILVER_EVENT), warehouse.read(SILVER_SALES), JAN10)
        warehouse.replace_day(GOLD_ITEM, items, JAN10)
        return {r.item_id: r.total_revenue for r in warehouse.read(GOLD_ITEM).collect()}

    assert revenue_after_loading(JAN10)["ITEM-309"] == -24400
    assert revenue_after_loading(JAN11)["ITEM-309"] == -8800


def test_no_rows_empties_the_day_only(spark, tmp_path):
    warehouse, bronze = events_table(spark, tmp_path)
    warehouse.replace_day(SILVER_EVENT, op.silver_event(bronze_of(spark, []), JAN10), JAN10)
    assert [r.event_id for r in warehouse.read(SILVER_EVENT).collect()] == ["e3"]
    warehouse.replace_day(SILVER_EVENT, op.silver_event(bronze, JAN10), JAN10)
    assert warehouse.read(SILVER_EVENT).count() == 8


def test_backfill_drops_days_without_records(spark, tmp_path):
    warehouse, bronze = events_table(spark, tmp_path)
    warehouse.replace_all(SILVER_EVENT, op.silver_event(bronze, JAN11))
    assert [r.event_id for r in warehouse.read(SILVER_EVENT).collect()] == ["e3"]


def test_new_catalog_finds_stored_days(spark, tmp_path):
    events_table(spark, tmp_path)
    reopened = fresh(spark, tmp_path)
    for _ in range(2):
        reopened.create(SILVER_EVENT)
    assert reopened.read(SILVER_EVENT).count() == 8


def test_columns_are_matched_by_name(spark, tmp_path):
    warehouse, bronze = events_table(spark, tmp_path)
    events = op.silver_event(bronze)
    warehouse.replace_all(SILVER_EVENT, events.select(*sorted(events.columns, reverse=True)))
    assert rows_of(warehouse.read(SILVER_EVENT)) == rows_of(events)
    with pytest.raises(Exception, match="event_hour"):
        warehouse.replace_all(SILVER_EVENT, events.drop("event_hour"))


def files_of(tmp_path, day):
    """Data files of a day, which has one version, in their folder."""
    (run,) = os.listdir(tmp_path / "silver" / "event" / f"event_date={day}")
    folder = tmp_path / "silver" / "event" / f"event_date={day}" / run
    return [f for f in os.listdir(folder) if f.startswith("part-")]


def test_layout_is_snappy_parquet_by_day(spark, tmp_path):
    events_table(spark, tmp_path)
    folder = tmp_path / "silver" / "event"
    assert {f"event_date={JAN10}", f"event_date={JAN11}"} <= set(os.listdir(folder))
    files = files_of(tmp_path, JAN10)
    assert len(files) == 1 and files[0].endswith(".snappy.parquet")


def test_a_day_read_prunes_partitions(spark, tmp_path):
    warehouse, _ = events_table(spark, tmp_path)
    plan = plan_of(op.gold_funnel(warehouse.read(SILVER_EVENT), JAN10))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "ReadSchema: struct<session_id:string,action:string>" in plan


@pytest.mark.parametrize("one_day", [True, False])
def test_a_hot_day_is_split_over_files(spark, tmp_path, one_day):
    records = spark.range(0, 60_000, 1, 16).selectExpr(
        "uuid() as event_id", "'2026-01-10 01:02:03' as event_timestamp", "uuid() as session_id",
        "'view' as action", "uuid() as item_id",
    )
    for name in BRONZE.names:
        if name not in records.columns:
            records = records.selectExpr("*", f"cast(null as string) as {name}")
    warehouse = fresh(spark, tmp_path)
    warehouse.create(SILVER_EVENT)
    previous = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        if one_day:
            warehouse.replace_day(SILVER_EVENT, op.silver_event(records, JAN10), JAN10)
        else:
            warehouse.replace_all(SILVER_EVENT, op.silver_event(records))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", previous)
    assert len(files_of(tmp_path, JAN10)) > 2
    assert warehouse.read(SILVER_EVENT).count() == 60_000


# --- switching versions


def failing(rows, column, good):
    """`rows`, of which all but the good ones fail in the stage that writes."""
    check = F.when(F.col(column).isin(good), F.col(column)).otherwise(F.raise_error(F.lit("broken row")))
    return rows.withColumn(column, check)


@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_a_write_that_fails_keeps_the_old_day(spark, tmp_path, layer):
    bronze, products = edge_tables(spark)
    warehouse = fresh(spark, tmp_path)
    backfill(warehouse, bronze, products)
    spec, column, good = (SILVER_EVENT, "event_id", ["e1"]) if layer == "silver" else (GOLD_ITEM, "item_id", ["ITEM-309"])
    before = rows_of(warehouse.read(spec))
    folders = warehouse.versions(spec).all_current()
    for put in (
        lambda rows: warehouse.replace_day(spec, rows.where(f"event_date = date'{JAN10}'"), JAN10),
        lambda rows: warehouse.replace_days(spec, rows, [JAN10, JAN11]),
        lambda rows: warehouse.replace_all(spec, rows),
    ):
        rows = warehouse.read(spec).repartition(3)
        with pytest.raises(Exception, match="broken row"):
            put(failing(rows, column, good))
        assert rows_of(warehouse.read(spec)) == before
        assert warehouse.versions(spec).all_current() == folders
    # Nothing of the failed runs is left, and another catalog sees the old days as well.
    for day, folder in folders.items():
        assert os.listdir(os.path.dirname(folder)) == [os.path.basename(folder)]
    reopened = fresh(spark, tmp_path)
    reopened.create(spec)
    assert rows_of(reopened.read(spec)) == before


def test_a_run_counts_only_when_all_is_written(spark, tmp_path):
    warehouse, bronze = events_table(spark, tmp_path)
    before = rows_of(warehouse.read(SILVER_EVENT))
    versions = warehouse.versions(SILVER_EVENT)
    run = versions.start()
    # As if the driver were lost after the files and before the marker.
    rows = SILVER_EVENT.conform(op.silver_event(bronze)).where("event_id = 'e1'")
    rows.withColumn("run", F.lit(run)).write.mode("append").partitionBy("event_date", "run").parquet(
        warehouse.location(SILVER_EVENT)
    )
    reopened = fresh(spark, tmp_path)
    reopened.create(SILVER_EVENT)
    assert rows_of(reopened.read(SILVER_EVENT)) == before
    versions.finish(run, None)
    reopened = fresh(spark, tmp_path)
    reopened.create(SILVER_EVENT)
    assert [r.event_id for r in reopened.read(SILVER_EVENT).collect()] == ["e1"]
    assert versions.current(date(2026, 1, 11)).endswith(run)


def test_old_versions_are_removed(spark, tmp_path):
    warehouse, bronze = events_table(spark, tmp_path)
    for _ in range(3):
        warehouse.replace_day(SILVER_EVENT, op.silver_event(bronze, JAN10), JAN10)
    for day in (JAN10, JAN11):
        assert len(os.listdir(tmp_path / "silver" / "event" / f"event_date={day}")) == 1
    assert warehouse.read(SILVER_EVENT).count() == 8


def test_a_table_may_be_replaced_by_what_was_read_of_it(spark, tmp_path):
    warehouse, _ = events_table(spark, tmp_path)
    warehouse.replace_all(SILVER_EVENT, warehouse.read(SILVER_EVENT).where("event_id <> 'e2'"))
    assert warehouse.read(SILVER_EVENT).count() == 6


# --- several days, and days that changed


def test_a_range_of_days_equals_single_days(spark, tmp_path):
    bronze, products = edge_tables(spark)
    single, range_ = fresh(spark, tmp_path / "a"), fresh(spark, tmp_path / "b")
    for day in (JAN10, JAN11):
        run_day(single, bronze, products, day)
    run_day(single, bronze, products, JAN10)
    run_days(range_, bronze, products, "2026-01-09", JAN11)
    for spec in PIPELINE_TABLES:
        assert rows_of(range_.read(spec)) == rows_of(single.read(spec)), spec.name


def test_a_range_leaves_other_days_and_empties_its_own(spark, tmp_path):
    bronze, products = edge_tables(spark)
    warehouse = fresh(spark, tmp_path)
    backfill(warehouse, bronze, products)
    before = rows_of(warehouse.read(SILVER_EVENT).where(f"event_date = date'{JAN11}'"))
    run_days(warehouse, bronze_of(spark, []), products, "2026-01-01", JAN10)
    assert rows_of(warehouse.read(SILVER_EVENT)) == before
    run_days(warehouse, bronze_of(spark, []), products, JAN11, JAN10)  # no days
    assert rows_of(warehouse.read(SILVER_EVENT)) == before


def test_late_records_refreshed_equal_a_backfill(spark, tmp_path):
    bronze, products = edge_tables(spark)
    path, root = str(tmp_path / "bronze"), tmp_path / "tables"
    warehouse, ever = fresh(spark, root), ["e1", "e3", "e4"]
    steps = [ever, ["e2", "e5"], ["e6", "e7", "e8"], ["e1"]]
    for ids in steps:
        land_batch(bronze.where(F.col("event_id").isin(ids)), path, buckets=2)
        landed = read_bronze(spark, path)
        days = refresh(warehouse, landed, products, [path])
        whole = fresh(spark, tmp_path / f"whole-{ids[0]}-{len(ids)}")
        backfill(whole, landed, products)
        for spec in PIPELINE_TABLES:
            assert rows_of(warehouse.read(spec)) == rows_of(whole.read(spec)), (ids, spec.name)
    assert days == []  # the last batch was a copy
    # e2 landed for the 10th alone, and moved the revenue of the 11th, on which its buyer bought.
    assert any(r.event_date.isoformat() == JAN11 and r.total_revenue != 0 for r in warehouse.read(GOLD_ITEM).collect())


def test_a_refresh_that_fails_is_made_up_for(spark, tmp_path, monkeypatch):
    bronze, products = edge_tables(spark)
    path = str(tmp_path / "bronze")
    warehouse = fresh(spark, tmp_path / "tables")
    land_batch(bronze.where("event_id <> 'e2'"), path, buckets=2)
    refresh(warehouse, read_bronze(spark, path), products, [path])
    land_batch(bronze, path, buckets=2)
    real = Warehouse.replace_days

    def fails_on_items(self, spec, *rest):
        if spec is GOLD_ITEM:
            raise OSError("lost")
        return real(self, spec, *rest)

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "replace_days", fails_on_items)
        with pytest.raises(OSError):
            refresh(warehouse, read_bronze(spark, path), products, [path])
    refresh(warehouse, read_bronze(spark, path), products, [path])
    whole = fresh(spark, tmp_path / "whole")
    backfill(whole, read_bronze(spark, path), products)
    for spec in PIPELINE_TABLES:
        assert rows_of(warehouse.read(spec)) == rows_of(whole.read(spec)), spec.name
    assert not os.path.exists(tmp_path / "tables" / "_item_days")


# --- the catalog's columns


def test_another_layout_fails_before_data_is_touched(spark, tmp_path):
    warehouse, bronze = events_table(spark, tmp_path)
    before = rows_of(warehouse.read(SILVER_EVENT))
    other = replace(SILVER_EVENT, fields=(("event_id", "bigint"), *SILVER_EVENT.fields[1:]))
    fewer = replace(SILVER_EVENT, fields=SILVER_EVENT.fields[:-1])
    moved = replace(SILVER_EVENT, fields=SILVER_EVENT.fields[::-1])
    parted = replace(SILVER_EVENT, partition="dt")
    for spec in (other, fewer, moved, parted):
        again = Warehouse(spark, str(tmp_path), prefix=warehouse.prefix)
        with pytest.raises(SchemaMismatch, match="silver_event"):
            again.create(spec)
        with pytest.raises(SchemaMismatch):
            again.replace_all(spec, op.silver_event(bronze).withColumn("dt", F.col("event_date")))
    assert rows_of(warehouse.read(SILVER_EVENT)) == before


def test_an_added_column_is_added_to_the_table(spark, tmp_path):
    warehouse, bronze = events_table(spark, tmp_path)
    wider = replace(SILVER_EVENT, fields=(*SILVER_EVENT.fields, ("shop", "string")))
    again = Warehouse(spark, str(tmp_path), prefix=warehouse.prefix)
    again.create(wider)
    assert {r.shop for r in again.read(wider).collect()} == {None}
    again.replace_day(wider, op.silver_event(bronze, JAN10).withColumn("shop", F.lit("a")), JAN10)
    shops = {(str(r.event_date), r.shop) for r in again.read(wider).collect()}
    assert shops == {(JAN10, "a"), (JAN11, None)}
