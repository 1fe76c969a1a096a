"""Column expressions shared by the queries. All stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The actions a valid record may carry.
ALLOWED_ACTIONS = ("view", "click", "add_to_cart", "wishlist", "search", "purchase")


def event_time() -> Column:
    """Record time as a zone-free timestamp; malformed text fails under ANSI mode."""
    return F.col("event_timestamp").cast("timestamp_ntz")


def event_day() -> Column:
    return event_time().cast("date")


def is_allowed() -> Column:
    return F.col("action").isin(*ALLOWED_ACTIONS)


def is_action(name: str) -> Column:
    """True or False, never NULL, so it can be summed or maximised as a flag."""
    return F.coalesce(F.col("action") == name, F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent, two decimals; NULL where whole is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def average(total: Column, count: Column) -> Column:
    """Two-decimal mean of an exact integer sum.

    AVG over BIGINT adds doubles, whose result depends on the order tasks finish in;
    dividing the integer sum does not. NULL where nothing was counted.
    """
    return F.round(F.try_divide(total, count), 2)
