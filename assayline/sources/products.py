"""Product master: a CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayline.schemas import PRODUCTS


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Typed without an inference pass; a wrong header or a bad number fails the job."""
    return (
        spark.read.schema(PRODUCTS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
