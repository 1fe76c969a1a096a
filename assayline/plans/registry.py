"""Every query by name, as a function of (session, folder of the supplied tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayline import operators as op
from assayline.functions import days_between, on_day, target_day
from assayline.operators.lookup import LookupBounds
from assayline.plans.pipeline import backfill, refresh, run_day, run_days
from assayline.schemas import (
    BRONZE_EVENT,
    CAMPAIGN_USERS,
    EVENT_PAIRS,
    FUNNEL_SESSIONS,
    GOLD_FUNNEL,
    GOLD_ITEM,
    GOLD_SALES_DAILY,
    GOLD_SALES_USER,
    PIPELINE_TABLES,
    REGION_USERS,
    SALES_PAIRS,
    SILVER_EVENT,
    SILVER_SALES,
    TableSpec,
)
from assayline.session import scratch_path
from assayline.sinks import Warehouse
from assayline.sources import (
    read_bronze,
    read_products,
    read_records,
    testdata,
    write_records,
)
from assayline.streaming import land_batch, land_stream

Query = Callable[[SparkSession, str], DataFrame]

# The day the daily runs load; the supplied events cover 2024-01-01 to 2024-01-30.
DAY = "2024-01-15"
RUN_DATE = "2024-01-16"
# Several days loaded in one run.
FIRST, LAST = "2024-01-10", "2024-01-20"
# The supplied tables are small: few files a day.
FEW_BUCKETS = 4


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.bronze_from_events(spark, sf_dir)


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.products_from_part(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bronze = _bronze(spark, sf_dir)
    return op.silver_event(bronze), op.silver_sales(bronze, _products(spark, sf_dir))


def _event_query(query, day: str | None = None) -> Query:
    """A gold query that reads events only, so no sales are built for it."""
    return lambda spark, sf_dir: query(op.silver_event(_bronze(spark, sf_dir)), day)


def _sales_query(query, day: str | None = None) -> Query:
    def run(spark, sf_dir):
        return query(op.silver_sales(_bronze(spark, sf_dir), _products(spark, sf_dir)), day)

    return run


def _item_query(query, day: str | None = None) -> Query:
    return lambda spark, sf_dir: query(*_silver(spark, sf_dir), day)


def _lines_query(query) -> Query:
    return lambda spark, sf_dir: query(testdata.sales_from_lineitem(spark, sf_dir))


_EVENT_QUERIES = {
    "gold_funnel": op.gold_funnel,
    "gold_device": op.gold_device,
    "gold_search": op.gold_search,
    "gold_campaign": op.gold_campaign,
}
_ITEM_QUERIES = {"gold_item": op.gold_item, "gold_item_by_order": op.gold_item_by_order}
_SALES_QUERIES = {
    "gold_sales_daily": op.gold_sales_daily,
    "gold_sales_product": op.gold_sales_product,
    "gold_sales_category": op.gold_sales_category,
    "gold_sales_user": op.gold_sales_user,
    "gold_sales_payment": op.gold_sales_payment,
    "gold_sales_region": op.gold_sales_region,
}


def silver_event(spark, sf_dir, day=None):
    return op.silver_event(_bronze(spark, sf_dir), day)


def silver_sales(spark, sf_dir, day=None):
    return op.silver_sales(_bronze(spark, sf_dir), _products(spark, sf_dir), day)


def silver_sales_shuffled(spark, sf_dir):
    """The product join as it runs when the product master is too large to broadcast."""
    products = _products(spark, sf_dir)
    return op.silver_sales(_bronze(spark, sf_dir), products, bounds=LookupBounds(rows=0))


# --- sources and landing ------------------------------------------------------------


def record_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records out as JSON lines and back in through the typed reader."""
    path = scratch_path(spark, "records")
    write_records(_bronze(spark, sf_dir), path)
    return read_records(spark.read, path)


def product_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product master out as CSV with a header and back in."""
    path = scratch_path(spark, "products")
    _products(spark, sf_dir).write.option("header", True).csv(path)
    return read_products(spark, path)


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record delivered, then the whole delivery sent again; landed once."""
    return _landed(_bronze(spark, sf_dir), "ingest")


def bronze_ingest_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with records that lack an id or a time or have a clock in 2099, out of
    order in several files and micro-batches."""
    number = F.col("event_id").cast("bigint")
    faulty = _bronze(spark, sf_dir).withColumns(
        {
            "event_id": F.when(number % 7 != 0, F.col("event_id")),
            "event_timestamp": F.when(number % 11 == 0, None)
            .when(number % 13 == 0, "2099-12-31 23:59:59")
            .otherwise(F.col("event_timestamp")),
        }
    )
    return _landed(faulty.repartition(3, F.hash("session_id")), "ingest-faulty", max_bytes=1)


def _landed(records: DataFrame, label: str, **options) -> DataFrame:
    spark = records.sparkSession
    root = scratch_path(spark, label)
    for _ in range(2):
        write_records(records, f"{root}/raw")
    land_stream(
        spark, f"{root}/raw", f"{root}/bronze", f"{root}/state", buckets=FEW_BUCKETS, **options
    )
    return BRONZE_EVENT.conform(read_bronze(spark, f"{root}/bronze"))


def record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth record delivered cut off and every eleventh with a time that is none; what
    landing sets aside, sent twice in one batch and read once more by a batch that runs again."""
    root = scratch_path(spark, "rejects")
    records = _bronze(spark, sf_dir)
    number = F.col("event_id").cast("bigint")
    cut = F.concat(F.lit('{"event_id": "'), "event_id", F.lit('", "quantity": '))
    soon = F.concat(F.lit('{"event_id": "'), "event_id", F.lit('", "event_timestamp": "soon"}'))
    bad = number % 9 == 0, number % 11 == 0
    write_records(records.where(~bad[0] & ~bad[1]), f"{root}/raw")
    lines = records.where(bad[0] | bad[1]).select(F.when(bad[0], cut).otherwise(soon))
    lines.write.mode("append").text(f"{root}/raw")
    land_stream(
        spark, f"{root}/raw", f"{root}/bronze", f"{root}/state",
        rejects_path=f"{root}/rejects", buckets=FEW_BUCKETS,
    )
    return spark.read.schema("line string, file string, reason string").json(f"{root}/rejects").select(
        "line", "reason"
    )


def silver_event_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the scheduled run of the day after DAY loads."""
    return silver_event(spark, sf_dir, target_day(RUN_DATE))


def table_silver_sales_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales backfilled from a landed folder of their own, and one day run again."""
    root = scratch_path(spark, "apart")
    records = _bronze(spark, sf_dir)
    land_batch(records.where("action <> 'purchase'"), f"{root}/events", buckets=FEW_BUCKETS)
    land_batch(records.where("action = 'purchase'"), f"{root}/sales", buckets=FEW_BUCKETS)
    events, sales = read_bronze(spark, f"{root}/events"), read_bronze(spark, f"{root}/sales")
    products = _products(spark, sf_dir)
    warehouse = Warehouse(spark, f"{root}/warehouse", prefix=f"run_{uuid.uuid4().hex}")
    backfill(warehouse, events, products, sales_bronze=sales)
    run_day(warehouse, events, products, DAY, sales_bronze=sales)
    return warehouse.read(SILVER_SALES)


# --- tables -------------------------------------------------------------------------


_warehouses: dict[tuple[str, str], Warehouse] = {}


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Backfill all thirteen tables, then run one day again; once per application."""
    loaded = (spark.sparkContext.applicationId, sf_dir)
    if loaded not in _warehouses:
        warehouse = Warehouse(
            spark, scratch_path(spark, "warehouse"), prefix=f"run_{uuid.uuid4().hex}"
        )
        bronze, products = _bronze(spark, sf_dir), _products(spark, sf_dir)
        backfill(warehouse, bronze, products)
        run_day(warehouse, bronze, products, DAY)
        _warehouses[loaded] = warehouse
    return _warehouses[loaded]


def _table_query(spec: TableSpec) -> Query:
    return lambda spark, sf_dir: _warehouse(spark, sf_dir).read(spec)


def gold_item_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day out of the stored tables: of the other days only the reduced sales are read."""
    warehouse = _warehouse(spark, sf_dir)
    tables = [warehouse.read(spec) for spec in (SILVER_EVENT, EVENT_PAIRS, SALES_PAIRS)]
    return op.gold_item_from_pairs(*tables, DAY)


_refreshed: dict[tuple[str, str], Warehouse] = {}


def _refreshed_query(spec: TableSpec) -> Query:
    """Two thirds of all records landed and loaded, the late third landed and followed."""

    def run(spark, sf_dir):
        loaded = (spark.sparkContext.applicationId, sf_dir)
        if loaded not in _refreshed:
            root = scratch_path(spark, "refresh")
            records, products = _bronze(spark, sf_dir), _products(spark, sf_dir)
            late = F.crc32("event_id") % 3 == 0
            warehouse = Warehouse(spark, f"{root}/tables", prefix=f"run_{uuid.uuid4().hex}")
            for part in (records.where(~late), records.where(late), records.where(late)):
                land_batch(part, f"{root}/bronze", buckets=FEW_BUCKETS)
                landed = read_bronze(spark, f"{root}/bronze")
                refresh(warehouse, landed, products, [f"{root}/bronze"])
            _refreshed[loaded] = warehouse
        return _refreshed[loaded].read(spec)

    return run


_ranged: dict[tuple[str, str], Warehouse] = {}


def _range_query(spec: TableSpec) -> Query:
    """The days from FIRST to LAST loaded in one run, in overlapping pieces."""

    def run(spark, sf_dir):
        loaded = (spark.sparkContext.applicationId, sf_dir)
        if loaded not in _ranged:
            root = scratch_path(spark, "range")
            warehouse = Warehouse(spark, root, prefix=f"run_{uuid.uuid4().hex}")
            records, products = _bronze(spark, sf_dir), _products(spark, sf_dir)
            for first, last in ((FIRST, DAY), (DAY, LAST)):
                run_days(warehouse, records, products, first, last)
            _ranged[loaded] = warehouse
        return _ranged[loaded].read(spec)

    return run


_sets: dict[tuple[str, str], Warehouse] = {}


def _span_query(spec: TableSpec) -> Query:
    """Distinct ids from FIRST to LAST out of bitmaps that were stored in pieces of days."""

    def run(spark, sf_dir):
        loaded = (spark.sparkContext.applicationId, sf_dir)
        if loaded not in _sets:
            root = scratch_path(spark, "sets")
            warehouse = Warehouse(spark, root, prefix=f"run_{uuid.uuid4().hex}")
            sources = dict(zip(("events", "sales"), _silver(spark, sf_dir)))
            codes = op.IdCodes(spark, f"{root}/codes")
            for table, (source, column) in _SETS.items():
                warehouse.create(table)
                # Two overlapping pieces: most ids of the second have their code already.
                for first, last in (("2024-01-01", DAY), (DAY, "2024-01-30")):
                    days = days_between(first, last)
                    rows = on_day(sources[source], table.partition, days)
                    codes.extend(rows.select(F.col(column).alias("id")))
                    sets = op.day_sets(rows, table, column, codes.read())
                    warehouse.replace_days(table, sets, days)
            _sets[loaded] = warehouse
        return op.distinct_over(_sets[loaded].read(spec), spec, days_between(FIRST, LAST))

    return run


_SETS = {
    FUNNEL_SESSIONS: ("events", "session_id"),
    CAMPAIGN_USERS: ("events", "user_id"),
    REGION_USERS: ("sales", "user_id"),
}


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "record_scan": record_scan,
        "product_scan": product_scan,
        "bronze_ingest": bronze_ingest,
        "bronze_ingest_faulty": bronze_ingest_faulty,
        "record_rejects": record_rejects,
        "silver_event_run_date": silver_event_run_date,
        "table_silver_sales_apart": table_silver_sales_apart,
        "silver_event": silver_event,
        "silver_sales": silver_sales,
        "silver_sales_shuffled": silver_sales_shuffled,
        "silver_event_1d": lambda spark, sf_dir: silver_event(spark, sf_dir, DAY),
        "silver_sales_1d": lambda spark, sf_dir: silver_sales(spark, sf_dir, DAY),
    }
    for build, group in (
        (_event_query, _EVENT_QUERIES),
        (_item_query, _ITEM_QUERIES),
        (_sales_query, _SALES_QUERIES),
    ):
        for name, query in group.items():
            found[name] = build(query)
            found[f"{name}_1d"] = build(query, DAY)
    for name, query in _SALES_QUERIES.items():
        found[f"{name}_lines"] = _lines_query(query)
    found["sales_from_lineitem"] = testdata.sales_from_lineitem
    found["gold_item_1d"] = gold_item_day
    for spec in PIPELINE_TABLES:
        found[f"table_{spec.name}"] = _table_query(spec)
    for spec in (SILVER_SALES, GOLD_FUNNEL, GOLD_ITEM, GOLD_SALES_DAILY):
        found[f"refreshed_{spec.name}"] = _refreshed_query(spec)
    for spec in (SILVER_EVENT, GOLD_SALES_USER):
        found[f"range_{spec.name}"] = _range_query(spec)
    for spec in _SETS:
        found[f"span_{spec.name}"] = _span_query(spec)
    return found
