"""Daily tables over events: funnel, device, search, campaign and item conversion.

Distinct counts go through one row per (group, id): map tasks collapse repeats first and
the exchange hashes on group and id together, so a hot group, session or copied event
never lands whole on one task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from assayline.functions import average, is_action, on_day, percent
from assayline.operators.lookup import LookupBounds, fits
from assayline.schemas import (
    EVENT_PAIRS,
    GOLD_CAMPAIGN,
    GOLD_DEVICE,
    GOLD_FUNNEL,
    GOLD_ITEM,
    GOLD_SEARCH,
    SALES_PAIRS,
)


def gold_funnel(events: DataFrame, day: date | str | None = None) -> DataFrame:
    """Distinct sessions per action and day."""
    rows = on_day(events, "event_date", day)
    return GOLD_FUNNEL.conform(
        rows.groupBy("action", "event_date").agg(
            F.countDistinct("session_id").alias("session_count")
        )
    )


def gold_device(events: DataFrame, day: date | str | None = None) -> DataFrame:
    """Event rows per device, action and day."""
    rows = on_day(events, "event_date", day)
    return GOLD_DEVICE.conform(
        rows.groupBy("device", "action", "event_date").agg(F.count("*").alias("cnt"))
    )


def gold_search(events: DataFrame, day: date | str | None = None) -> DataFrame:
    """Searches per keyword and day."""
    rows = on_day(events, "event_date", day).where(F.col("action") == "search")
    return GOLD_SEARCH.conform(
        rows.groupBy("search_keyword", "event_date").agg(
            F.count("*").alias("count_search_keyword")
        )
    )


def gold_campaign(events: DataFrame, day: date | str | None = None) -> DataFrame:
    """Visitors, purchase sessions and session conversion per campaign and day."""
    rows = on_day(events, "event_date", day).where(F.col("campaign_id").isNotNull())
    counts = rows.groupBy("campaign_id", "event_date").agg(
        F.countDistinct("user_id").alias("visit_user_count"),
        F.countDistinct(F.when(is_action("purchase"), F.col("session_id"))).alias(
            "purchase_count"
        ),
        F.countDistinct("session_id").alias("sessions"),
    )
    return GOLD_CAMPAIGN.conform(
        counts.withColumn("conversion_rate", percent(F.col("purchase_count"), F.col("sessions")))
    )


def _item_sessions(events: DataFrame) -> DataFrame:
    """Per item and day: sessions that viewed, carted and bought it."""
    steps = {"view_count": "view", "cart_count": "add_to_cart", "purchase_count": "purchase"}
    per_session = events.groupBy("item_id", "event_date", "session_id").agg(
        *[F.bool_or(is_action(action)).alias(name) for name, action in steps.items()]
    )
    known = F.col("session_id").isNotNull()
    return per_session.select(
        "item_id",
        "event_date",
        *[(known & F.col(name)).cast("bigint").alias(name) for name in steps],
        F.lit(None).cast("bigint").alias("revenue"),
        F.lit(0).cast("bigint").alias("sales"),
    )


def _item_table(sessions: DataFrame, money: DataFrame) -> DataFrame:
    """Stack session counts and revenue per (item, day), then add them up.

    Revenue only ever arises for a purchase event, so its (item, day) always has session
    rows too: adding equals the outer join without sorting either side.
    """
    none = F.lit(0).cast("bigint")
    stacked = sessions.union(
        money.select("item_id", "event_date", none, none, none, "revenue", "sales")
    )
    totals = stacked.groupBy("item_id", "event_date").agg(
        F.sum("view_count").alias("view_count"),
        F.sum("cart_count").alias("cart_count"),
        F.sum("purchase_count").alias("purchase_count"),
        F.sum("revenue").alias("revenue"),
        F.sum("sales").alias("sales"),
    )
    return GOLD_ITEM.conform(
        totals.withColumns(
            {
                "conversion_rate": percent(F.col("purchase_count"), F.col("view_count")),
                "total_revenue": F.coalesce("revenue", F.lit(0)),
                "avg_order_amount": F.coalesce(
                    average(F.col("revenue"), F.col("sales")), F.lit(0.0)
                ),
            }
        )
    )


def event_pairs(events: DataFrame, day: date | str | None = None) -> DataFrame:
    """Purchase events per item, user and day; guests and events without an item left out."""
    rows = on_day(events, "event_date", day).where(F.col("action") == "purchase")
    return EVENT_PAIRS.conform(
        rows.where(F.col("item_id").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("item_id", "user_id", "event_date")
        .agg(F.count("*").alias("times"))
    )


def sales_pairs(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    """Amount and number of priced sales per item, user and day."""
    rows = on_day(sales, "dt", day)
    return SALES_PAIRS.conform(
        rows.where(F.col("item_id").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("item_id", "user_id", "dt")
        .agg(F.sum("total_amount").alias("amount"), F.count("total_amount").alias("priced"))
    )


def _pair_money(bought: DataFrame, history: DataFrame, measures, narrowed: bool, bounds) -> DataFrame:
    """Revenue and number of sales per (item, day): purchases times the sales of their pair.

    For some days only, the history is first narrowed to the pairs that bought on them. They
    are counted and, within the bounds, broadcast, so the history is not shuffled.
    """
    if narrowed:
        pairs = bought.select("item_id", "user_id")
        if fits(pairs, bounds):
            pairs = F.broadcast(pairs)
        history = history.join(pairs, ["item_id", "user_id"], "left_semi")
    sold = history.groupBy("item_id", "user_id").agg(*measures)
    return bought.join(sold, ["item_id", "user_id"]).select(
        "item_id",
        "event_date",
        (F.col("times") * F.col("amount")).alias("revenue"),
        (F.col("times") * F.col("priced")).alias("sales"),
    )


def gold_item(
    events: DataFrame,
    sales: DataFrame,
    day: date | str | None = None,
    bounds: LookupBounds = LookupBounds(),
) -> DataFrame:
    """Item conversion plus revenue, matching purchases to sales by item and user.

    Each purchase event of an (item, user) pair counts all sales of that pair, from every
    loaded day, so a pair with several purchases counts them several times; guests match
    nothing. Joining k purchase events to m sales would make k*m rows: here both sides are
    first reduced to one row per pair (and day), and the sums are multiplied instead.
    """
    rows = on_day(events, "event_date", day).where(F.col("item_id").isNotNull())
    history = sales.where(F.col("item_id").isNotNull() & F.col("user_id").isNotNull())
    measures = F.sum("total_amount").alias("amount"), F.count("total_amount").alias("priced")
    money = _pair_money(event_pairs(events, day), history, measures, day is not None, bounds)
    return _item_table(_item_sessions(rows), money)


def gold_item_from_pairs(
    events: DataFrame,
    bought: DataFrame,
    sold: DataFrame,
    day: date | str | None = None,
    bounds: LookupBounds = LookupBounds(),
) -> DataFrame:
    """gold_item out of the stored `event_pairs` and `sales_pairs` of all days.

    A run of one day reads that day of the events and of the purchases, and of all other days
    only the reduced sales pairs.
    """
    rows = on_day(events, "event_date", day).where(F.col("item_id").isNotNull())
    measures = F.sum("amount").alias("amount"), F.sum("priced").alias("priced")
    money = _pair_money(on_day(bought, "event_date", day), sold, measures, day is not None, bounds)
    return _item_table(_item_sessions(rows), money)


def changed_item_days(
    bought: DataFrame, stored: DataFrame, renewed: DataFrame, bounds: LookupBounds = LookupBounds()
) -> DataFrame:
    """event_date of every day whose gold_item changes when `stored` sales pairs of some days
    give way to `renewed` ones: days on which a pair bought whose sums are no longer the same.
    """
    def side(pairs, sign):
        amount = F.coalesce("amount", F.lit(0)) * sign
        return pairs.select("item_id", "user_id", amount.alias("amount"), (F.col("priced") * sign).alias("priced"))

    # Totals of the pair over all the days, as a purchase counts them wherever they lie.
    moved = (
        side(renewed, 1).union(side(stored, -1))
        .groupBy("item_id", "user_id")
        .agg(F.sum("amount").alias("amount"), F.sum("priced").alias("priced"))
        .where("amount <> 0 OR priced <> 0")
        .select("item_id", "user_id")
    )
    if fits(moved, bounds):
        moved = F.broadcast(moved)
    return bought.join(moved, ["item_id", "user_id"], "left_semi").select("event_date").distinct()


def gold_item_by_order(
    events: DataFrame, sales: DataFrame, day: date | str | None = None
) -> DataFrame:
    """Item conversion plus revenue, matching each purchase event to its own order.

    An order is its id and its day, so a day alone gives what it gives among all days.
    Guests count. Both sides are reduced to one row per order before they meet.
    """
    rows = on_day(events, "event_date", day).where(F.col("item_id").isNotNull())
    bought = (
        rows.where((F.col("action") == "purchase") & F.col("event_id").isNotNull())
        .groupBy(F.col("event_id").alias("order_id"), "item_id", "event_date")
        .agg(F.count("*").alias("times"))
    )
    sold = (
        on_day(sales, "dt", day)
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id", F.col("dt").alias("event_date"))
        .agg(F.sum("total_amount").alias("amount"), F.count("total_amount").alias("priced"))
    )
    money = bought.join(sold, ["order_id", "event_date"]).select(
        "item_id",
        "event_date",
        (F.col("times") * F.col("amount")).alias("revenue"),
        (F.col("times") * F.col("priced")).alias("sales"),
    )
    return _item_table(_item_sessions(rows), money)
