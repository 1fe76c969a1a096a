"""The expected result of each registered query, as SQL over the supplied tables."""

from __future__ import annotations

from assayline.functions import ALLOWED_ACTIONS
from assayline.plans.registry import DAY, FIRST, LAST
from assayline.schemas import PIPELINE_TABLES


def _padded(prefix: str, number: str) -> str:
    return (
        f"'{prefix}' || CASE WHEN length({number}) < 3 THEN lpad({number}, 3, '0') ELSE {number} END"
    )


BRONZE = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       substring(CAST(ts AS VARCHAR), 1, 19) AS event_timestamp,
       CASE WHEN event_id % 5 <> 0 THEN {_padded('USER-', 'CAST(user_id AS VARCHAR)')} END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN 'SESS-GUEST-' || CAST(1000 + event_id % 9000 AS VARCHAR)
            ELSE {_padded('SESS-', 'CAST(user_id * 5 + event_id % 5 AS VARCHAR)')} END AS session_id,
       CASE WHEN event_type = 'signup' AND event_id % 3 = 2 THEN NULL
            ELSE {_padded('ITEM-', "regexp_extract(props, '([0-9]+)', 1)")} END AS item_id,
       CASE WHEN event_type <> 'signup' THEN event_type
            WHEN event_id % 3 = 0 THEN 'add_to_cart'
            WHEN event_id % 3 = 1 THEN 'wishlist' ELSE 'search' END AS action,
       CASE event_id % 7 WHEN 0 THEN 'tablet' WHEN 1 THEN 'desktop' WHEN 2 THEN 'desktop'
            ELSE 'mobile' END AS device,
       CASE WHEN event_id % 2 = 0 THEN 'app' ELSE 'web' END AS platform,
       CASE WHEN event_type = 'purchase' AND event_id % 13 <> 0
            THEN 'R' || CAST(event_id % 7 AS VARCHAR) END AS region,
       CASE event_id % 4 WHEN 0 THEN 'ad' WHEN 1 THEN 'search' WHEN 2 THEN 'sns'
            ELSE 'direct' END AS referrer,
       CASE WHEN event_id % 4 = 0
            THEN {_padded('CAMP-', 'CAST(1 + event_id % 3 AS VARCHAR)')} END AS campaign_id,
       CASE WHEN event_type = 'signup' AND event_id % 3 = 2
            THEN 'kw' || CAST(event_id % 10 AS VARCHAR) END AS search_keyword,
       'page' AS page_type,
       CASE WHEN event_type = 'purchase' THEN CAST(1 + event_id % 5 AS INTEGER) END AS quantity,
       CASE WHEN event_type = 'purchase'
            THEN CAST((event_id % 6) * 1000 AS INTEGER) END AS discount_amount,
       CASE WHEN event_type = 'purchase' THEN
            CASE event_id % 4 WHEN 0 THEN 'bank_transfer' WHEN 1 THEN 'kakao_pay'
                 WHEN 2 THEN 'naver_pay' ELSE 'card' END END AS payment_method
FROM events"""

PRODUCTS = f"""
SELECT CASE WHEN p_brand = 'Brand#1' THEN {_padded('OLD-', 'CAST(p_partkey AS VARCHAR)')}
            ELSE {_padded('ITEM-', 'CAST(p_partkey AS VARCHAR)')} END AS item_id,
       p_name AS name, p_type AS category, CAST(round(p_retailprice * 100) AS BIGINT) AS price
FROM part"""

SILVER_EVENT = """
SELECT event_id, moment AS event_timestamp, CAST(date_part('hour', moment) AS INTEGER) AS event_hour,
       strftime(moment, '%a') AS event_dow, user_id, user_id IS NOT NULL AS is_member, session_id,
       item_id, action, page_type, device, platform, referrer, campaign_id, search_keyword,
       TRUE AS is_valid_action, CAST(moment AS DATE) AS event_date
FROM (SELECT *, CAST(event_timestamp AS TIMESTAMP) AS moment FROM bronze)
WHERE action IN ({allowed}) AND moment IS NOT NULL""".format(
    allowed=", ".join(f"'{action}'" for action in ALLOWED_ACTIONS)
)

SILVER_SALES = """
SELECT b.event_id AS order_id, b.user_id, CAST(b.event_timestamp AS TIMESTAMP) AS order_time,
       b.region, b.item_id, p.category, p.price AS unit_price, b.quantity, b.discount_amount,
       p.price * b.quantity - b.discount_amount AS total_amount, b.payment_method,
       CAST(CAST(b.event_timestamp AS TIMESTAMP) AS DATE) AS dt
FROM (SELECT * FROM bronze WHERE action = 'purchase' AND event_timestamp IS NOT NULL) AS b LEFT JOIN products AS p USING (item_id)"""

LINE_SALES = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
       CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS user_id, o_orderdate AS order_time, r_name AS region,
       CAST(l_partkey AS VARCHAR) AS item_id, p_type AS category,
       CAST(round(p_retailprice * 100) AS BIGINT) AS unit_price,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(round(l_discount * 100) AS INTEGER) * 1000 AS discount_amount,
       CAST(round(p_retailprice * 100) AS BIGINT) * CAST(l_quantity AS INTEGER)
         - CAST(round(l_discount * 100) AS INTEGER) * 1000 AS total_amount,
       o_orderpriority AS payment_method, CAST(o_orderdate AS DATE) AS dt
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

# Faulty records: some without an id, some without a time, some with a clock in 2099.
FAULTY_LANDED = f"""
WITH faulty AS (
    SELECT CASE WHEN CAST(event_id AS BIGINT) % 7 <> 0 THEN event_id END AS event_id,
           CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 THEN NULL
                WHEN CAST(event_id AS BIGINT) % 13 = 0 THEN '2099-12-31 23:59:59'
                ELSE event_timestamp END AS event_timestamp,
           * EXCLUDE (event_id, event_timestamp)
    FROM ({BRONZE}) AS records
), dated AS (
    SELECT *, CAST(CAST(event_timestamp AS TIMESTAMP) AS DATE) AS event_date FROM faulty
)
SELECT * FROM dated WHERE event_id IS NOT NULL
UNION ALL SELECT DISTINCT * FROM dated WHERE event_id IS NULL"""

REJECTS = f"""
SELECT CASE WHEN number % 9 = 0 THEN '{{"event_id": "' || event_id || '", "quantity": '
            ELSE '{{"event_id": "' || event_id || '", "event_timestamp": "soon"}}' END AS line,
       CASE WHEN number % 9 = 0 THEN 'malformed' ELSE 'time' END AS reason
FROM (SELECT event_id, CAST(event_id AS BIGINT) AS number FROM ({BRONZE}) AS records)
WHERE number % 9 = 0 OR number % 11 = 0"""

_PAIRS = """item_id IS NOT NULL AND user_id IS NOT NULL GROUP BY ALL"""
EVENT_PAIRS = f"""
SELECT item_id, user_id, count(*) AS times, event_date
FROM silver_event WHERE action = 'purchase' AND {_PAIRS}"""
SALES_PAIRS = f"""
SELECT item_id, user_id, CAST(sum(total_amount) AS BIGINT) AS amount,
       count(total_amount) AS priced, dt
FROM silver_sales WHERE {_PAIRS}"""

_ITEM_SESSIONS = """
SELECT item_id, event_date,
       count(DISTINCT session_id) FILTER (WHERE action = 'view') AS view_count,
       count(DISTINCT session_id) FILTER (WHERE action = 'add_to_cart') AS cart_count,
       count(DISTINCT session_id) FILTER (WHERE action = 'purchase') AS purchase_count
FROM silver_event WHERE item_id IS NOT NULL GROUP BY ALL"""


def _half_up(total: str, count: str) -> str:
    """total / count to two decimals, ties away from zero, in whole numbers throughout."""
    return (
        f"CAST(sign({total}) * ((abs({total}) * 200 + {count}) // nullif(2 * {count}, 0)) "
        "AS DOUBLE) / 100"
    )


_MEAN = _half_up("sum(total_amount)", "count(total_amount)")


def _item(match: str) -> str:
    """Every matching pair of purchase event and sales row, unreduced."""
    return f"""
SELECT item_id, view_count, cart_count, purchase_count,
       {_half_up('100 * purchase_count', 'view_count')} AS conversion_rate,
       coalesce(revenue, 0) AS total_revenue, coalesce(mean, 0.0) AS avg_order_amount, event_date
FROM ({_ITEM_SESSIONS}) AS counts
LEFT JOIN (
    SELECT e.item_id, e.event_date, CAST(sum(total_amount) AS BIGINT) AS revenue,
           {_MEAN} AS mean
    FROM silver_event AS e JOIN silver_sales AS s ON {match}
    WHERE e.action = 'purchase' AND e.item_id IS NOT NULL
    GROUP BY e.item_id, e.event_date
) AS money USING (item_id, event_date)"""


def _kpis(*measures: str, key: str | None = None) -> str:
    """Revenue measures by day and key."""
    known = {
        "total_revenue": "CAST(sum(total_amount) AS BIGINT)",
        "total_spent": "CAST(sum(total_amount) AS BIGINT)",
        "order_count": "count(DISTINCT order_id)",
        "user_count": "count(DISTINCT user_id)",
        "total_quantity": "CAST(sum(quantity) AS BIGINT)",
        "avg_order_amount": _MEAN,
    }
    columns = [f"{known[name]} AS {name}" for name in measures]
    columns = ([key] if key else []) + columns + ["dt AS order_date"]
    where = f"WHERE {key} IS NOT NULL " if key else ""
    return f"SELECT {', '.join(columns)} FROM silver_sales {where}GROUP BY ALL"


_PLAIN = ("total_revenue", "order_count", "total_quantity", "avg_order_amount")

EVENT_SQL = {
    "gold_funnel": """
SELECT action, count(session_id) AS session_count, event_date
FROM (SELECT DISTINCT action, session_id, event_date FROM silver_event)
GROUP BY action, event_date""",
    "gold_device": """
SELECT device, action, count(*) AS cnt, event_date
FROM silver_event GROUP BY device, action, event_date""",
    "gold_search": """
SELECT search_keyword, count(*) AS count_search_keyword, event_date
FROM silver_event WHERE action = 'search' GROUP BY search_keyword, event_date""",
    "gold_campaign": f"""
SELECT campaign_id, visitors AS visit_user_count, buyers AS purchase_count,
       {_half_up('100 * buyers', 'sessions')} AS conversion_rate, event_date
FROM (
    SELECT campaign_id, event_date, count(DISTINCT user_id) AS visitors,
           count(DISTINCT session_id) AS sessions,
           count(DISTINCT session_id) FILTER (WHERE action = 'purchase') AS buyers
    FROM silver_event WHERE campaign_id IS NOT NULL GROUP BY ALL
)""",
}
ITEM_SQL = {
    "gold_item": _item("e.item_id = s.item_id AND e.user_id = s.user_id"),
    "gold_item_by_order": _item("e.event_id = s.order_id AND e.event_date = s.dt"),
}
SALES_SQL = {
    "gold_sales_daily": _kpis(
        "total_revenue", "order_count", "user_count", "total_quantity", "avg_order_amount"
    ),
    "gold_sales_product": _kpis(*_PLAIN, key="item_id"),
    "gold_sales_category": _kpis(*_PLAIN, key="category"),
    "gold_sales_user": _kpis(
        "order_count", "total_spent", "total_quantity", "avg_order_amount", key="user_id"
    ),
    "gold_sales_payment": _kpis(
        "total_revenue", "order_count", "avg_order_amount", key="payment_method"
    ),
    "gold_sales_region": _kpis(
        "total_revenue", "order_count", "user_count", "avg_order_amount", key="region"
    ),
}


def _with(body: str, **tables: str) -> str:
    steps = ", ".join(f"{name} AS ({sql})" for name, sql in tables.items())
    return f"WITH {steps} {body}"


def _over_events(body: str, day: str | None = None) -> str:
    """Run `body` over the silver tables; a day narrows its result by the date column."""
    whole = _with(
        body,
        bronze=BRONZE,
        products=PRODUCTS,
        silver_event=SILVER_EVENT,
        silver_sales=SILVER_SALES,
    )
    if day is None:
        return whole
    date_column = next(c for c in ("order_date", "event_date", "dt") if f" {c}" in body)
    return f"SELECT * FROM ({whole}) WHERE {date_column} = DATE '{day}'"


def oracle_sql() -> dict[str, str]:
    landed = (
        "SELECT *, CAST(CAST(event_timestamp AS TIMESTAMP) AS DATE) AS event_date "
        f"FROM ({BRONZE}) AS records"
    )
    found = {
        "record_scan": BRONZE,
        "product_scan": PRODUCTS,
        "bronze_ingest": landed,
        "bronze_ingest_faulty": FAULTY_LANDED,
        "record_rejects": REJECTS,
        "sales_from_lineitem": LINE_SALES,
    }
    silver = {
        "silver_event": "SELECT * FROM silver_event ",
        "silver_sales": "SELECT * FROM silver_sales ",
    }
    date_of = {"silver_event": "event_date", "silver_sales": "dt"}
    for name, body in silver.items():
        found[name] = _over_events(body)
        found[f"{name}_1d"] = _over_events(f"{body} WHERE {date_of[name]} = DATE '{DAY}'")
    found["silver_sales_shuffled"] = found["silver_sales"]
    found["silver_event_run_date"] = found["silver_event_1d"]
    found["table_silver_sales_apart"] = found["silver_sales"]
    for name, body in {**EVENT_SQL, **ITEM_SQL, **SALES_SQL}.items():
        found[name] = _over_events(body)
        found[f"{name}_1d"] = _over_events(body, DAY)
    for name, body in SALES_SQL.items():
        found[f"{name}_lines"] = _with(body, silver_sales=LINE_SALES)
    pairs = {"silver_event_pairs": EVENT_PAIRS, "silver_sales_pairs": SALES_PAIRS}
    whole = found | {name: _over_events(body) for name, body in pairs.items()}
    for spec in PIPELINE_TABLES:
        found[f"table_{spec.name}"] = whole[spec.name]
    for name in ("silver_sales", "gold_funnel", "gold_item", "gold_sales_daily"):
        found[f"refreshed_{name}"] = found[name]
    for name, table, group, column, day in (
        ("funnel_sessions", "silver_event", "action", "session_id", "event_date"),
        ("campaign_users", "silver_event", "campaign_id", "user_id", "event_date"),
        ("region_users", "silver_sales", "region", "user_id", "dt"),
    ):
        # A group whose ids are all null has no set.
        found[f"span_sets_{name}"] = _over_events(
            f"SELECT {group}, count(DISTINCT {column}) AS distinct_ids FROM {table} "
            f"WHERE {group} IS NOT NULL AND {column} IS NOT NULL "
            f"AND {day} BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY {group}"
        )
    for name, column in (("silver_event", "event_date"), ("gold_sales_user", "order_date")):
        found[f"range_{name}"] = (
            f"SELECT * FROM ({found[name]}) WHERE {column} BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
        )
    return found
