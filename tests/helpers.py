"""Row comparison and the hand-made records the edge tests share."""

from __future__ import annotations

import pyarrow as pa

from assayline.schemas import BRONZE, PRODUCTS


def rows_of(df) -> list[tuple]:
    return in_order(tuple(row) for row in df.select(*sorted(df.columns)).collect())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def in_order(rows) -> list[tuple]:
    return sorted(rows, key=repr)


def duck_rows(con, sql: str) -> list[tuple]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    order = [names.index(name) for name in sorted(names)]
    return in_order(tuple(row[i] for i in order) for row in cursor.fetchall())


def record(event_id, at, session, action, **given):
    fields = {name: None for name in BRONZE.names}
    fields |= {
        "event_id": event_id,
        "event_timestamp": at,
        "session_id": session,
        "action": action,
        "device": "mobile",
        "platform": "app",
        "page_type": "p",
        "referrer": "ad" if "campaign_id" in given else "direct",
    }
    return fields | given


E2 = record(
    "e2",
    "2026-01-10 09:00:30",
    "SESS-001",
    "purchase",
    user_id="USER-001",
    item_id="ITEM-309",
    campaign_id="CAMP-001",
    region="서울",
    quantity=1,
    discount_amount=10000,
    payment_method="card",
)

EDGE_RECORDS = [
    record(
        "e1",
        "2026-01-10 09:00:00",
        "SESS-001",
        "view",
        user_id="USER-001",
        item_id="ITEM-309",
        campaign_id="CAMP-001",
    ),
    E2,
    E2,
    record(
        "e3",
        "2026-01-11 00:00:00",
        "SESS-002",
        "purchase",
        user_id="USER-001",
        item_id="ITEM-309",
        region="서울",
        quantity=2,
        discount_amount=0,
        payment_method="card",
    ),
    record(
        "e4",
        "2026-01-10 12:00:00",
        "SESS-GUEST-1234",
        "purchase",
        item_id="ITEM-101",
        device="desktop",
        region="부산",
        quantity=1,
        discount_amount=1000,
        payment_method="card",
    ),
    record(
        "e5",
        "2026-01-10 13:00:00",
        "SESS-006",
        "purchase",
        user_id="USER-002",
        item_id="ITEM-999",
        region="경기",
        quantity=1,
        discount_amount=0,
        payment_method="kakao_pay",
    ),
    record(
        "e6", "2026-01-10 14:00:00", "SESS-006", "error", user_id="USER-002", item_id="ITEM-101"
    ),
    record(
        "e7",
        "2026-01-10 23:59:59",
        "SESS-007",
        "search",
        user_id="USER-002",
        campaign_id="CAMP-001",
        search_keyword="운동화",
    ),
    record(
        "e8", "2026-01-10 12:00:00", "SESS-GUEST-1234", "view", item_id="ITEM-101", device="desktop"
    ),
]

EDGE_PRODUCTS = [
    ("ITEM-309", "생수 2L 6개입", "식품", 3900),
    ("ITEM-101", "무선 이어폰", "전자기기", 129000),
]


def frame_of(spark, records: list[dict], schema):
    """Through Arrow, so reading the rows back needs no Python worker."""
    columns = {name: [r[name] for r in records] for name in schema.names}
    return spark.createDataFrame(pa.table(columns) if records else [], schema)


def bronze_of(spark, records):
    return frame_of(spark, records, BRONZE)


def edge_tables(spark):
    products = [dict(zip(PRODUCTS.names, row)) for row in EDGE_PRODUCTS]
    return bronze_of(spark, EDGE_RECORDS), frame_of(spark, products, PRODUCTS)
