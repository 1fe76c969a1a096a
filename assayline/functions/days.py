"""Which calendar day a run covers. Nothing here reads the clock."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F


def as_day(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def as_days(value: date | str | Iterable[date | str]) -> list[date]:
    """One day or several, each once, in order."""
    return [as_day(value)] if isinstance(value, (date, str)) else sorted(set(map(as_day, value)))


def days_between(first: date | str, last: date | str) -> list[date]:
    """Every day from the first to the last; none if the last is earlier."""
    first, last = as_day(first), as_day(last)
    return [first + timedelta(days=k) for k in range((last - first).days + 1)]


def target_day(run_date: date | str) -> date:
    """The day a scheduled run loads: the one before its logical date.

    Both the filter and the partition that gets replaced are derived from this one
    value, so they cannot drift apart.
    """
    return as_day(run_date) - timedelta(days=1)


def on_day(
    df: DataFrame, column: str, day: date | str | Iterable[date | str] | None
) -> DataFrame:
    """Keep one day, or several, of a table partitioned by `column`; None keeps every day."""
    if day is None:
        return df
    days = as_days(day)
    return df.where(F.col(column) == F.lit(days[0]) if len(days) == 1 else F.col(column).isin(days))
