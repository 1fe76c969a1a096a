"""The daily run, runs of several days, the backfill and the refresh of changed days.

Silver first, then the reduced pairs that gold_item reads, then the eleven gold tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, functions as F

from assayline import operators as op, schemas as s
from assayline.functions import as_days, days_between
from assayline.schemas import TableSpec
from assayline.sinks import Warehouse
from assayline.sinks.folders import Folders
from assayline.streaming.changes import ChangedDays

_FROM_EVENTS = {
    s.GOLD_FUNNEL: op.gold_funnel,
    s.GOLD_DEVICE: op.gold_device,
    s.GOLD_SEARCH: op.gold_search,
    s.GOLD_CAMPAIGN: op.gold_campaign,
}
_FROM_SALES = {
    s.GOLD_SALES_DAILY: op.gold_sales_daily,
    s.GOLD_SALES_PRODUCT: op.gold_sales_product,
    s.GOLD_SALES_CATEGORY: op.gold_sales_category,
    s.GOLD_SALES_USER: op.gold_sales_user,
    s.GOLD_SALES_PAYMENT: op.gold_sales_payment,
    s.GOLD_SALES_REGION: op.gold_sales_region,
}
Day = date | str | Iterable[date | str] | None


def gold_frames(events: DataFrame, sales: DataFrame, day: Day = None) -> dict[TableSpec, DataFrame]:
    """The ten gold queries that read nothing but their own days, not yet run."""
    return {spec: query(events, day) for spec, query in _FROM_EVENTS.items()} | {
        spec: query(sales, day) for spec, query in _FROM_SALES.items()
    }


def run_day(
    warehouse: Warehouse,
    bronze: DataFrame,
    products: DataFrame,
    day: date | str,
    jobs: int = 4,
    *,
    sales_bronze: DataFrame | None = None,
) -> None:
    """Replace one day in all tables. Running it again changes nothing.

    gold_item matches the day's purchases to sales of every loaded day, so its numbers for
    a past day move when later sales have been loaded meanwhile; `refresh` follows them.
    """
    _run(warehouse, bronze, products, as_days(day), jobs, sales_bronze)


def run_days(
    warehouse: Warehouse,
    bronze: DataFrame,
    products: DataFrame,
    first: date | str,
    last: date | str,
    jobs: int = 4,
    *,
    sales_bronze: DataFrame | None = None,
) -> None:
    """Replace all days from the first to the last, each table in one job.

    Days without records become empty, days outside stay as they are.
    """
    _run(warehouse, bronze, products, days_between(first, last), jobs, sales_bronze)


def backfill(
    warehouse: Warehouse,
    bronze: DataFrame,
    products: DataFrame,
    jobs: int = 4,
    *,
    sales_bronze: DataFrame | None = None,
) -> None:
    """Replace the whole of all tables from all records."""
    _run(warehouse, bronze, products, None, jobs, sales_bronze)


def refresh(
    warehouse: Warehouse,
    bronze: DataFrame,
    products: DataFrame,
    bronze_paths: Iterable[str],
    jobs: int = 4,
    *,
    sales_bronze: DataFrame | None = None,
) -> list[date]:
    """Bring all tables up to what has landed since the last refresh; returns the days.

    Landing notes the days of every batch. Exactly these are replaced in all tables, and of
    gold_item those days too on which a pair of item and user bought whose sales have changed,
    wherever these lie. Afterwards the tables are what a backfill would make of them. A refresh
    that fails is made up for by the next: the notes count as done last of all, and the days
    of gold_item are noted before the pairs they were derived from change.
    """
    notes = [ChangedDays(warehouse.spark, path) for path in bronze_paths]
    pending = [note.pending(warehouse.root) for note in notes]
    days = as_days({day for entries in pending for own in entries.values() for day in own})
    if days:
        _run(warehouse, bronze, products, days, jobs, sales_bronze, follow=True)
    for note, entries in zip(notes, pending):
        note.done(warehouse.root, entries)
    return days


def _run(warehouse, bronze, products, days: list[date] | None, jobs, sales_bronze, follow=False):
    """Sales come from records of their own, `sales_bronze`, or else from the event records."""
    if days == []:
        return
    orders = bronze if sales_bronze is None else sales_bronze
    warehouse.create_all()

    def store(spec: TableSpec, rows: DataFrame, by_day: bool = False, days=days) -> None:
        if days is None:
            warehouse.replace_all(spec, rows, by_day)
        else:
            # One day is written where it lies; more are as well if read by day.
            warehouse.replace_days(spec, rows, days, by_day and len(days) > 1)

    _together(
        jobs,
        partial(store, s.SILVER_EVENT, op.silver_event(bronze, days), _is_landed(bronze)),
        partial(store, s.SILVER_SALES, op.silver_sales(orders, products, days), _is_landed(orders)),
    )
    events, sales = warehouse.read(s.SILVER_EVENT, days), warehouse.read(s.SILVER_SALES, days)
    bought = op.event_pairs(events, days)
    item_days, notes = days, None
    if follow:
        store(s.EVENT_PAIRS, bought)
        item_days, notes = _noted_item_days(warehouse, op.sales_pairs(sales, days), days)
    _together(
        jobs,
        *([] if follow else [partial(store, s.EVENT_PAIRS, bought)]),
        partial(store, s.SALES_PAIRS, op.sales_pairs(sales, days)),
        *[partial(store, spec, rows) for spec, rows in gold_frames(events, sales, days).items()],
    )
    # The purchases of these days and, as any may count, the sales pairs of all days.
    items = op.gold_item_from_pairs(
        warehouse.read(s.SILVER_EVENT, item_days),
        warehouse.read(s.EVENT_PAIRS, item_days),
        warehouse.read(s.SALES_PAIRS),
        item_days,
    )
    store(s.GOLD_ITEM, items, days=item_days)
    if notes:
        Folders(warehouse.spark).remove(notes)


def _noted_item_days(warehouse: Warehouse, renewed: DataFrame, days: list[date]):
    """Days of gold_item that follow from renewed sales pairs, with those that a refresh that
    failed had noted; and the folder they are noted in until they are done."""
    stored = warehouse.read(s.SALES_PAIRS).where(F.col("dt").isin(days))
    moved = op.changed_item_days(warehouse.read(s.EVENT_PAIRS), stored, renewed)
    found = {row[0] for row in moved.collect()}  # days, as many as the calendar has
    folder, files = f"{warehouse.root}/_item_days", Folders(warehouse.spark)
    names = [name.split("_")[0] for name in files.names(folder)]
    every = as_days(found | set(days) | set(as_days(names)))
    for day in every:
        files.write(f"{folder}/{day.isoformat()}_{uuid.uuid4().hex[:8]}")
    return every, folder


def _is_landed(bronze: DataFrame) -> bool:
    return s.BRONZE_EVENT.partition in bronze.columns


def _together(jobs: int, *tasks) -> None:
    """Submit independent writes side by side, so one's last tasks do not idle the cluster."""
    with ThreadPoolExecutor(max_workers=jobs) as pool:
        for done in [pool.submit(task) for task in tasks]:
            done.result()
