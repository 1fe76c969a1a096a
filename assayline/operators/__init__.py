from assayline.operators.distinct_sets import IdCodes, day_sets, distinct_over
from assayline.operators.gold_events import (
    changed_item_days,
    event_pairs,
    gold_campaign,
    gold_device,
    gold_funnel,
    gold_item,
    gold_item_by_order,
    gold_item_from_pairs,
    gold_search,
    sales_pairs,
)
from assayline.operators.gold_sales import (
    gold_sales_category,
    gold_sales_daily,
    gold_sales_payment,
    gold_sales_product,
    gold_sales_region,
    gold_sales_user,
)
from assayline.operators.lookup import lookup_join
from assayline.operators.silver import silver_event, silver_sales

__all__ = [
    "IdCodes",
    "changed_item_days",
    "day_sets",
    "distinct_over",
    "event_pairs",
    "gold_campaign",
    "gold_device",
    "gold_funnel",
    "gold_item",
    "gold_item_by_order",
    "gold_item_from_pairs",
    "gold_sales_category",
    "gold_sales_daily",
    "gold_sales_payment",
    "gold_sales_product",
    "gold_sales_region",
    "gold_sales_user",
    "gold_search",
    "lookup_join",
    "sales_pairs",
    "silver_event",
    "silver_sales",
]
