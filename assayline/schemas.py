"""Declared shape of every table, and the one place that enforces it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

# These names, types and their order are the data contract.

BRONZE_FIELDS = (
    ("event_id", "string"),
    ("event_timestamp", "string"),
    ("user_id", "string"),
    ("session_id", "string"),
    ("item_id", "string"),
    ("action", "string"),
    ("device", "string"),
    ("platform", "string"),
    ("region", "string"),
    ("referrer", "string"),
    ("campaign_id", "string"),
    ("search_keyword", "string"),
    ("page_type", "string"),
    ("quantity", "int"),
    ("discount_amount", "int"),
    ("payment_method", "string"),
)

PRODUCT_FIELDS = (
    ("item_id", "string"),
    ("name", "string"),
    ("category", "string"),
    ("price", "bigint"),
)

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct_of(fields) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


BRONZE = struct_of(BRONZE_FIELDS)
PRODUCTS = struct_of(PRODUCT_FIELDS)


@dataclass(frozen=True)
class TableSpec:
    """A date-partitioned table; the partition column comes last."""

    layer: str
    name: str
    folder: str
    fields: tuple[tuple[str, str], ...]
    partition: str
    # Aggregated from the layer's own tables, so its rows have been shuffled.
    rollup: bool = False

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields] + [self.partition]

    @property
    def schema(self) -> T.StructType:
        return struct_of(self.fields + ((self.partition, "date"),))

    def conform(self, df: DataFrame) -> DataFrame:
        """Columns by name, in declared order and type; a missing one fails at analysis."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])


def _gold(name: str, partition: str, *fields: tuple[str, str]) -> TableSpec:
    return TableSpec("gold", f"gold_{name}", name, fields, partition)


BRONZE_EVENT = TableSpec("bronze", "bronze_event", "event", BRONZE_FIELDS, "event_date")

SILVER_EVENT = TableSpec(
    "silver",
    "silver_event",
    "event",
    (
        ("event_id", "string"),
        ("event_timestamp", "timestamp_ntz"),
        ("event_hour", "int"),
        ("event_dow", "string"),
        ("user_id", "string"),
        ("is_member", "boolean"),
        ("session_id", "string"),
        ("item_id", "string"),
        ("action", "string"),
        ("page_type", "string"),
        ("device", "string"),
        ("platform", "string"),
        ("referrer", "string"),
        ("campaign_id", "string"),
        ("search_keyword", "string"),
        ("is_valid_action", "boolean"),
    ),
    "event_date",
)

SILVER_SALES = TableSpec(
    "silver",
    "silver_sales",
    "sales",
    (
        ("order_id", "string"),
        ("user_id", "string"),
        ("order_time", "timestamp_ntz"),
        ("region", "string"),
        ("item_id", "string"),
        ("category", "string"),
        ("unit_price", "bigint"),
        ("quantity", "int"),
        ("discount_amount", "int"),
        ("total_amount", "bigint"),
        ("payment_method", "string"),
    ),
    "dt",
)

# Reduced by day, so that gold_item reads them for all days in place of events and sales.
EVENT_PAIRS = TableSpec(
    "silver",
    "silver_event_pairs",
    "event_pairs",
    (("item_id", "string"), ("user_id", "string"), ("times", "bigint")),
    "event_date",
    rollup=True,
)
SALES_PAIRS = TableSpec(
    "silver",
    "silver_sales_pairs",
    "sales_pairs",
    (("item_id", "string"), ("user_id", "string"), ("amount", "bigint"), ("priced", "bigint")),
    "dt",
    rollup=True,
)

GOLD_FUNNEL = _gold("funnel", "event_date", ("action", "string"), ("session_count", "bigint"))
GOLD_DEVICE = _gold(
    "device", "event_date", ("device", "string"), ("action", "string"), ("cnt", "bigint")
)
GOLD_SEARCH = _gold(
    "search", "event_date", ("search_keyword", "string"), ("count_search_keyword", "bigint")
)
GOLD_CAMPAIGN = _gold(
    "campaign",
    "event_date",
    ("campaign_id", "string"),
    ("visit_user_count", "bigint"),
    ("purchase_count", "bigint"),
    ("conversion_rate", "double"),
)
GOLD_ITEM = _gold(
    "item",
    "event_date",
    ("item_id", "string"),
    ("view_count", "bigint"),
    ("cart_count", "bigint"),
    ("purchase_count", "bigint"),
    ("conversion_rate", "double"),
    ("total_revenue", "bigint"),
    ("avg_order_amount", "double"),
)
GOLD_SALES_DAILY = _gold(
    "sales_daily",
    "order_date",
    ("total_revenue", "bigint"),
    ("order_count", "bigint"),
    ("user_count", "bigint"),
    ("total_quantity", "bigint"),
    ("avg_order_amount", "double"),
)
GOLD_SALES_PRODUCT = _gold(
    "sales_product",
    "order_date",
    ("item_id", "string"),
    ("total_revenue", "bigint"),
    ("order_count", "bigint"),
    ("total_quantity", "bigint"),
    ("avg_order_amount", "double"),
)
GOLD_SALES_CATEGORY = _gold(
    "sales_category",
    "order_date",
    ("category", "string"),
    ("total_revenue", "bigint"),
    ("order_count", "bigint"),
    ("total_quantity", "bigint"),
    ("avg_order_amount", "double"),
)
GOLD_SALES_USER = _gold(
    "sales_user",
    "order_date",
    ("user_id", "string"),
    ("order_count", "bigint"),
    ("total_spent", "bigint"),
    ("total_quantity", "bigint"),
    ("avg_order_amount", "double"),
)
GOLD_SALES_PAYMENT = _gold(
    "sales_payment",
    "order_date",
    ("payment_method", "string"),
    ("total_revenue", "bigint"),
    ("order_count", "bigint"),
    ("avg_order_amount", "double"),
)
GOLD_SALES_REGION = _gold(
    "sales_region",
    "order_date",
    ("region", "string"),
    ("total_revenue", "bigint"),
    ("order_count", "bigint"),
    ("user_count", "bigint"),
    ("avg_order_amount", "double"),
)

def sets_of(name: str, group: str, partition: str) -> TableSpec:
    """Bitmaps of the ids that each value of `group` has on a day, in pieces of 32,768 codes."""
    fields = ((group, "string"), ("bucket", "bigint"), ("bitmap", "binary"))
    return TableSpec("gold", f"sets_{name}", f"sets_{name}", fields, partition)


FUNNEL_SESSIONS = sets_of("funnel_sessions", "action", "event_date")
CAMPAIGN_USERS = sets_of("campaign_users", "campaign_id", "event_date")
REGION_USERS = sets_of("region_users", "region", "dt")

GOLD_TABLES = (
    GOLD_FUNNEL,
    GOLD_DEVICE,
    GOLD_SEARCH,
    GOLD_CAMPAIGN,
    GOLD_ITEM,
    GOLD_SALES_DAILY,
    GOLD_SALES_PRODUCT,
    GOLD_SALES_CATEGORY,
    GOLD_SALES_USER,
    GOLD_SALES_PAYMENT,
    GOLD_SALES_REGION,
)
PIPELINE_TABLES = (SILVER_EVENT, SILVER_SALES, EVENT_PAIRS, SALES_PAIRS) + GOLD_TABLES
