"""Shop records derived from the supplied star-schema and event tables.

Whole tables in, no rows left out: `events` becomes raw records, `part` the product
master, and `lineitem` with its dimensions a large sales table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assayline.schemas import SILVER_SALES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(prefix: str, number: Column) -> Column:
    """prefix plus at least three digits; longer numbers keep all of theirs."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix), F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    )


def bronze_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records: one in five is a guest's, `error` is an action no record may carry."""
    n, kind = F.col("event_id"), F.col("event_type")
    item_number = F.regexp_extract("props", "([0-9]+)", 1)
    is_search = (kind == "signup") & (n % 3 == 2)
    is_purchase = kind == "purchase"
    is_guest = n % 5 == 0
    return table(spark, sf_dir, "events").select(
        n.cast("string").alias("event_id"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("event_timestamp"),
        F.when(~is_guest, _padded("USER-", F.col("user_id"))).alias("user_id"),
        F.when(is_guest, F.concat(F.lit("SESS-GUEST-"), (1000 + n % 9000).cast("string")))
        .otherwise(_padded("SESS-", F.col("user_id") * 5 + n % 5))
        .alias("session_id"),
        F.when(~is_search, _padded("ITEM-", item_number)).alias("item_id"),
        F.when(kind != "signup", kind)
        .when(n % 3 == 0, "add_to_cart")
        .when(n % 3 == 1, "wishlist")
        .otherwise("search")
        .alias("action"),
        F.when(n % 7 == 0, "tablet")
        .when((n % 7).isin(1, 2), "desktop")
        .otherwise("mobile")
        .alias("device"),
        F.when(n % 2 == 0, "app").otherwise("web").alias("platform"),
        F.when(is_purchase & (n % 13 != 0), F.concat(F.lit("R"), (n % 7).cast("string"))).alias(
            "region"
        ),
        F.when(n % 4 == 0, "ad")
        .when(n % 4 == 1, "search")
        .when(n % 4 == 2, "sns")
        .otherwise("direct")
        .alias("referrer"),
        F.when(n % 4 == 0, _padded("CAMP-", 1 + n % 3)).alias("campaign_id"),
        F.when(is_search, F.concat(F.lit("kw"), (n % 10).cast("string"))).alias("search_keyword"),
        F.lit("page").alias("page_type"),
        F.when(is_purchase, (1 + n % 5).cast("int")).alias("quantity"),
        F.when(is_purchase, ((n % 6) * 1000).cast("int")).alias("discount_amount"),
        F.when(
            is_purchase,
            F.when(n % 4 == 0, "bank_transfer")
            .when(n % 4 == 1, "kakao_pay")
            .when(n % 4 == 2, "naver_pay")
            .otherwise("card"),
        ).alias("payment_method"),
    )


def products_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master. One brand carries ids no record uses, so its items stay unknown."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_brand") == "Brand#1", _padded("OLD-", key))
        .otherwise(_padded("ITEM-", key))
        .alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"),
    )


def sales_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales row per order line, the largest input for the sales KPIs."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )
    price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    quantity = F.col("l_quantity").cast("int")
    discount = F.round(F.col("l_discount") * 100).cast("int") * 1000
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return SILVER_SALES.conform(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat_ws("-", *keys).alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("order_time"),
            F.col("r_name").alias("region"),
            F.col("l_partkey").alias("item_id"),
            F.col("p_type").alias("category"),
            price.alias("unit_price"),
            quantity.alias("quantity"),
            discount.alias("discount_amount"),
            (price * quantity - discount).alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderdate").cast("date").alias("dt"),
        )
    )
