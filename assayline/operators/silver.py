"""Raw records to the two cleaned tables. Neither shuffles the records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from assayline.functions import event_day, event_time, is_allowed, on_day
from assayline.operators.lookup import LookupBounds, lookup_join
from assayline.schemas import BRONZE_EVENT, SILVER_EVENT, SILVER_SALES


def _records_of(bronze: DataFrame, day: date | str | None) -> DataFrame:
    """Records with their own date; one day's only if asked.

    A record without a time has no date and belongs to no day, so it stays in bronze.

    Landed records already carry that date as their partition, so there the filter
    prunes folders instead of casting every row.
    """
    landed = BRONZE_EVENT.partition in bronze.columns
    dated = bronze if landed else bronze.withColumn(BRONZE_EVENT.partition, event_day())
    return on_day(dated.where(F.col(BRONZE_EVENT.partition).isNotNull()), BRONZE_EVENT.partition, day)


def silver_event(bronze: DataFrame, day: date | str | None = None) -> DataFrame:
    """Events with an allowed action, typed, with hour, weekday and member flag."""
    rows = _records_of(bronze, day).where(is_allowed())
    return SILVER_EVENT.conform(
        rows.withColumns(
            {
                "event_timestamp": event_time(),
                "event_hour": F.hour(event_time()),
                "event_dow": F.dayname(F.col("event_date")),
                "is_member": F.col("user_id").isNotNull(),
                "is_valid_action": F.when(is_allowed(), True).otherwise(False),
            }
        )
    )


def silver_sales(
    bronze: DataFrame,
    products: DataFrame,
    day: date | str | None = None,
    bounds: LookupBounds = LookupBounds(),
) -> DataFrame:
    """Purchases with category, price and amount from the product master.

    An unknown item keeps its row with NULL category, price and amount. A discount may
    exceed the price; the amount is then negative.
    """
    purchases = _records_of(bronze, day).where(F.col("action") == "purchase")
    priced = lookup_join(purchases, products, "item_id", ["category", "price"], bounds)
    return SILVER_SALES.conform(
        priced.select(
            F.col("event_id").alias("order_id"),
            "user_id",
            event_time().alias("order_time"),
            "region",
            "item_id",
            "category",
            F.col("price").alias("unit_price"),
            "quantity",
            "discount_amount",
            (F.col("price") * F.col("quantity") - F.col("discount_amount")).alias("total_amount"),
            "payment_method",
            F.col("event_date").alias("dt"),
        )
    )
