"""Random rows where one value holds a third of every column, NULLs and copies included."""

import random
from datetime import date, datetime, timedelta

import duckdb
import pyarrow as pa
import pytest

from assayline import operators as op
from assayline.plans.oracle import EVENT_SQL, ITEM_SQL, SALES_SQL
from assayline.schemas import SILVER_EVENT, SILVER_SALES
from tests.helpers import duck_rows, frame_of, rows_of

ACTIONS = ["view", "click", "add_to_cart", "wishlist", "search", "purchase"]


def skewed(rng, values, nulls=0.1):
    """The first value a third of the time, NULL in some rows, else any."""
    draw = rng.random()
    if draw < nulls:
        return None
    return values[0] if draw < nulls + 1 / 3 else rng.choice(values)


def numbered(prefix, n):
    return [f"{prefix}{i}" for i in range(n)]


def make_events(rng, count):
    for i in range(count):
        at = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(96))
        user = skewed(rng, numbered("U", 6), 0.2)
        yield {
            "event_id": skewed(rng, numbered("E", count), 0),
            "event_timestamp": at,
            "event_hour": at.hour,
            "event_dow": at.strftime("%a"),
            "user_id": user,
            "is_member": user is not None,
            "session_id": skewed(rng, numbered("S", 20)),
            "item_id": skewed(rng, numbered("I", 8)),
            "action": skewed(rng, ACTIONS[::-1], 0),
            "page_type": "p",
            "device": skewed(rng, ["mobile", "desktop"], 0),
            "platform": "app",
            "referrer": "ad",
            "campaign_id": skewed(rng, numbered("C", 3), 0.3),
            "search_keyword": skewed(rng, numbered("k", 3)),
            "is_valid_action": True,
            "event_date": at.date(),
        }


def make_sales(rng, count):
    for _ in range(count):
        at = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(96))
        yield {
            "order_id": skewed(rng, numbered("E", count), 0.05),
            "user_id": skewed(rng, numbered("U", 6), 0.2),
            "order_time": at,
            "region": skewed(rng, numbered("R", 4)),
            "item_id": skewed(rng, numbered("I", 8)),
            "category": skewed(rng, numbered("c", 3)),
            "unit_price": 100,
            "quantity": rng.choice([None, 1, 2, 3]),
            "discount_amount": 0,
            "total_amount": rng.choice([None, -700, 0, 100, 250, 3333]),
            "payment_method": skewed(rng, numbered("P", 3)),
            "dt": at.date(),
        }


@pytest.fixture(scope="module", params=[1, 2])
def tables(spark, request):
    rng = random.Random(request.param)
    events, sales = list(make_events(rng, 900)), list(make_sales(rng, 500))
    con = duckdb.connect()
    frames = []
    for spec, rows in ((SILVER_EVENT, events), (SILVER_SALES, sales)):
        frames.append(frame_of(spark, rows, spec.schema))
        con.register(spec.name, pa.Table.from_pylist(rows))
    return con, *frames


@pytest.mark.parametrize("name", [*EVENT_SQL, *SALES_SQL, *ITEM_SQL])
def test_against_sql(tables, name):
    con, events, sales = tables
    inputs = (events, sales) if name in ITEM_SQL else (events,) if name in EVENT_SQL else (sales,)
    query = {**EVENT_SQL, **SALES_SQL, **ITEM_SQL}[name]
    assert rows_of(getattr(op, name)(*inputs)) == duck_rows(con, query)


@pytest.mark.parametrize("name", ["gold_item", "gold_item_by_order"])
def test_day_reads_sales_of_all_days(tables, name):
    con, events, sales = tables
    day = date(2024, 1, 2)
    expected = duck_rows(con, f"SELECT * FROM ({ITEM_SQL[name]}) WHERE event_date = DATE '{day}'")
    assert rows_of(getattr(op, name)(events, sales, day)) == expected
