from assayline.functions.days import as_day, as_days, days_between, on_day, target_day
from assayline.functions.measures import (
    ALLOWED_ACTIONS,
    average,
    event_day,
    event_time,
    is_action,
    is_allowed,
    percent,
)

__all__ = [
    "ALLOWED_ACTIONS",
    "as_day",
    "as_days",
    "average",
    "days_between",
    "event_day",
    "event_time",
    "is_action",
    "is_allowed",
    "on_day",
    "percent",
    "target_day",
]
