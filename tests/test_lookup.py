"""The dimension join: measured broadcast, and the merge join beyond its bounds."""

import pytest
from pyspark.sql import functions as F

from assayline.operators.lookup import LookupBounds, fits, lookup_join
from tests.helpers import in_order, plan_of

TINY = LookupBounds(rows=3)


@pytest.fixture(scope="module")
def facts(spark):
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
        .otherwise(F.when(F.col("id") % 2 == 0, F.lit("missing")))
    )
    return spark.range(0, 3000, 1, 8).select(F.col("id"), key.alias("item"))


@pytest.fixture(scope="module")
def dimension(spark):
    rows = [("hot", 1), ("hot", 2), (None, 9)] + [(f"k{i}", i) for i in range(40)]
    return spark.createDataFrame(rows, "item string, price long")


def test_both_ways_equal_the_plain_join(facts, dimension):
    plain = in_order(tuple(r) for r in facts.join(dimension, "item", "left").collect())
    for bounds in (LookupBounds(), TINY):
        joined = lookup_join(facts, dimension, "item", ["price"], bounds)
        assert in_order(tuple(r) for r in joined.select("item", "id", "price").collect()) == plain
    assert len(plain) == 4000


def test_size_decides(spark, dimension):
    assert fits(dimension, LookupBounds())
    assert not fits(dimension, TINY)
    assert not fits(dimension, LookupBounds(bytes=100))
    assert fits(dimension.limit(0), LookupBounds(bytes=0))


def test_within_bounds_facts_are_not_shuffled(facts, dimension):
    plan = plan_of(lookup_join(facts, dimension, "item", ["price"]))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_beyond_bounds_nothing_is_broadcast(facts, dimension):
    plan = plan_of(lookup_join(facts, dimension, "item", ["price"], TINY))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert plan.count("Range (") == 1  # the facts are read once


def test_hot_key_spreads_over_tasks(spark, facts, dimension):
    small = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        joined = lookup_join(facts, dimension, "item", ["price"], TINY)
        tasks = joined.withColumn("p", F.spark_partition_id()).where("item = 'hot'").select("p")
        assert tasks.distinct().count() > 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
