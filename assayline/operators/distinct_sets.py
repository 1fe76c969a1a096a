"""Exact distinct counts that add up over days: ids coded once, bitmaps per group and day.

A count of distinct ids over several days can't be had from the counts of the days. Their
sets can be united: every id has a whole number, and the ids of a group and day are bits of
bitmaps, 32,768 numbers each. The union over any span of days is an OR of a few kilobytes
for each piece, whatever the number of events behind them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from assayline.functions import on_day
from assayline.schemas import TableSpec
from assayline.sinks.folders import Folders


class IdCodes:
    """Numbers of ids from 0, in the order they are first met; an id keeps its number.

    Stored under a folder, one file set for each call that met new ids.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        """id and code; empty before any id has been coded."""
        schema = "id string, code bigint"
        if not self._batches():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{b}" for b in self._batches()])

    def extend(self, ids: DataFrame) -> None:
        """Give numbers to those of the ids (column `id`) that have none. Nulls get none.

        The new ids are written once with their place in their part; the parts' sizes, one
        number each, are added up, so the numbers leave no gaps and nothing is sorted.
        """
        new = ids.select(F.col("id").cast("string").alias("id")).where("id IS NOT NULL").distinct()
        known = self.read()
        new = new.join(known.hint("merge"), "id", "left_anti")
        batch = f"batch-{len(self._batches()):08d}"
        raw = f"{self.path}/_new-{batch}"
        new.withColumn("at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(raw)
        placed = self.spark.read.schema("id string, at bigint").parquet(raw)
        # Upper bits tell the part, the 33 lower ones the place in it.
        part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
        before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row a part
        starts = sizes.withColumn("start", F.coalesce(before, F.lit(0))).drop("n")
        used = known.agg(F.coalesce(F.max("code") + 1, F.lit(0))).first()[0]
        coded = placed.join(F.broadcast(starts), part == F.col("part")).select(
            "id", (F.lit(used) + F.col("start") + place).alias("code")
        )
        coded.write.mode("overwrite").parquet(f"{self.path}/{batch}")
        Folders(self.spark).remove(raw)

    def _batches(self) -> list[str]:
        """Batches that were written to their end."""
        folders = Folders(self.spark)
        names = [n for n in folders.names(self.path) if n.startswith("batch-")]
        return sorted(n for n in names if folders.exists(f"{self.path}/{n}/_SUCCESS"))


def day_sets(rows: DataFrame, spec: TableSpec, id_column: str, codes: DataFrame, day=None) -> DataFrame:
    """The bitmaps of `spec`: for each value of its first column and day the ids it has.

    Rows without a value or an id have no part. All ids must have been coded; one without
    a number fails the job, as it would be missing from every count.
    """
    group, days = spec.fields[0][0], spec.partition
    pairs = (
        on_day(rows, days, day)
        .where(F.col(group).isNotNull() & F.col(id_column).isNotNull())
        .select(group, days, F.col(id_column).cast("string").alias("id"))
        .distinct()
    )
    coded = pairs.join(codes.hint("merge"), "id", "left").withColumn(
        "code", F.coalesce("code", F.raise_error(F.concat(F.lit("no code for "), "id")).cast("bigint"))
    )
    return spec.conform(
        coded.groupBy(group, days, F.bitmap_bucket_number("code").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bitmap")
        )
    )


def distinct_over(
    sets: DataFrame, spec: TableSpec, days: Iterable[date | str] | None = None
) -> DataFrame:
    """Distinct ids of each group over some days, or over all, from stored bitmaps."""
    group = spec.fields[0][0]
    united = on_day(sets, spec.partition, days).groupBy(group, "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap")
    )
    return united.groupBy(group).agg(F.sum(F.bitmap_count("bitmap")).alias("distinct_ids"))
