"""Daily revenue tables over silver_sales, one helper for all six keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from assayline.functions import average, on_day
from assayline.schemas import (
    GOLD_SALES_CATEGORY,
    GOLD_SALES_DAILY,
    GOLD_SALES_PAYMENT,
    GOLD_SALES_PRODUCT,
    GOLD_SALES_REGION,
    GOLD_SALES_USER,
    TableSpec,
)


def _kpis(sales: DataFrame, spec: TableSpec, key: str | None, day: date | str | None) -> DataFrame:
    """Measures per (key, day); only those `spec` declares are computed.

    A sales row is partitioned by dt, which is the date of its order_time, so grouping and
    filtering on dt reads one partition and skips the timestamp column.
    """
    rows = on_day(sales, "dt", day)
    if key:
        rows = rows.where(F.col(key).isNotNull())
    group = ([key] if key else []) + [F.col("dt").alias("order_date")]
    total, priced = F.sum("total_amount"), F.count("total_amount")
    measures = {
        "total_revenue": total,
        "total_spent": total,
        "order_count": F.countDistinct("order_id"),
        "user_count": F.countDistinct("user_id"),
        "total_quantity": F.sum("quantity"),
        "avg_order_amount": average(total, priced),
    }
    wanted = [measures[name].alias(name) for name in spec.columns if name in measures]
    return spec.conform(rows.groupBy(*group).agg(*wanted))


def gold_sales_daily(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    return _kpis(sales, GOLD_SALES_DAILY, None, day)


def gold_sales_product(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    return _kpis(sales, GOLD_SALES_PRODUCT, "item_id", day)


def gold_sales_category(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    return _kpis(sales, GOLD_SALES_CATEGORY, "category", day)


def gold_sales_user(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    return _kpis(sales, GOLD_SALES_USER, "user_id", day)


def gold_sales_payment(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    return _kpis(sales, GOLD_SALES_PAYMENT, "payment_method", day)


def gold_sales_region(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    return _kpis(sales, GOLD_SALES_REGION, "region", day)
