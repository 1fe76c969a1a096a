"""Land JSON records as the typed bronze table, dropping records delivered again.

Delivery is at-least-once: after a partial failure a whole batch is sent again, so copies
are identical records and fall on the same event_date. A record without a time belongs to
the day without a date, a record without an id is identified by all its fields.

The landed table is bucketed by what identifies a record. A micro-batch is dealt into the
same buckets and compared with them where they lie: of what has landed, only that one column
of the touched days is read, and it is not shuffled. A batch too large for a task a bucket is
dealt into several parts of each bucket, and that one column with it, so that no task grows
with the batch. Each batch adds a file to every bucket of its days, or to every part of one;
`compact` makes one of them again. Days are kept in versions (`sinks.versions`),
batches go into the current one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assayline.functions import event_day
from assayline.schemas import BRONZE, BRONZE_EVENT
from assayline.sinks.folders import Folders
from assayline.sinks.versions import Versions
from assayline.sources import read_records, split_records
from assayline.streaming.changes import ChangedDays

KEY = "record_key"
BUCKETS = 16
# Bytes of a batch, as rows in memory, that one task sorts.
TASK_BYTES = 64 * 1024 * 1024
# The version that batches write until a day is first compacted.
_LANDED = "0000000000-landed"
_COLUMNS = ", ".join(f"{column} {kind}" for column, kind in BRONZE_EVENT.fields) + f", {KEY} string"


class LandedTable:
    """The catalog's view of a landed folder, by day as far as days are asked for.

    How many buckets a folder has is noted in it, as no later session may take another number.
    """

    _open: dict[tuple[str, str], LandedTable] = {}

    @classmethod
    def at(cls, spark: SparkSession, path: str, buckets: int = BUCKETS) -> LandedTable:
        opened = (spark.sparkContext.applicationId, path.rstrip("/"))
        if opened not in cls._open:
            cls._open[opened] = cls(spark, opened[1], buckets)
        return cls._open[opened]

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.path, folders = path, Folders(spark)
        noted = [n for n in folders.names(path) if n.startswith("_buckets-")]
        if not noted and any("=" in n for n in folders.names(path)):
            raise ValueError(f"{path} holds days that were not landed in buckets")
        self.buckets = int(noted[0].split("-")[1]) if noted else buckets
        self.versions = Versions(spark, path, BRONZE_EVENT.partition)
        if not noted:
            folders.write(f"{path}/_runs/{_LANDED}")
            folders.write(f"{path}/_buckets-{buckets}")
        self.name = f"landed_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # of a session before; files stay
        spark.sql(
            f"CREATE TABLE {self.name} ({_COLUMNS}, {BRONZE_EVENT.partition} date) USING PARQUET "
            f"PARTITIONED BY ({BRONZE_EVENT.partition}) CLUSTERED BY ({KEY}) INTO {self.buckets} "
            f"BUCKETS LOCATION '{path}'"
        )
        self._runs: set[str] = set()
        self._days: dict[date | None, str] = {}

    def see(self, spark: SparkSession, days: Iterable[date | None]) -> None:
        """Make the catalog read these days from their current versions."""
        runs = set(self.versions.counting())
        asked = set(days) | (set(self._days) if runs != self._runs else set())
        fresh = {}
        for day in asked:
            if day not in self._days or runs != self._runs:
                folder = self.versions.current(day, runs) or self.versions.folder(day, _LANDED)
                if self._days.get(day) != folder:
                    fresh[day] = folder
        added = {d: f for d, f in fresh.items() if d not in self._days}
        if added:
            parts = " ".join(f"{self._part(d)} LOCATION '{f}'" for d, f in added.items())
            spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {parts}")
        for day in fresh.keys() - added.keys():
            spark.sql(f"ALTER TABLE {self.name} {self._part(day)} SET LOCATION '{fresh[day]}'")
        if fresh:
            spark.catalog.refreshTable(self.name)
        self._days |= fresh
        self._runs = runs

    def moved(self) -> bool:
        """Whether a day has been given another version since it was last seen."""
        return set(self.versions.counting()) != self._runs

    @staticmethod
    def _part(day: date | None) -> str:
        return f"PARTITION (event_date = {'null' if day is None else f"DATE'{day.isoformat()}'"})"


def land_batch(records: DataFrame, bronze_path: str, *, buckets: int = BUCKETS) -> None:
    """Append the records that are not yet landed on their day, and note the days they are of.

    Copies inside the batch are dropped, copies across batches found by an anti-join with
    the landed records of the days this batch touches. So any lateness and any wrong clock
    is exact, nothing is kept as state, and a batch that runs twice lands once. `buckets` is
    taken when the folder is first landed in.
    """
    # Read three times, for its days, its new records and theirs; parsed once.
    records = records.persist()
    try:
        _land(records, bronze_path, buckets)
    finally:
        records.unpersist()


def _land(records: DataFrame, bronze_path: str, buckets: int) -> None:
    table = LandedTable.at(records.sparkSession, bronze_path, buckets)
    while _append(records, table) and table.moved():
        pass  # A day was compacted meanwhile, maybe without this batch: what it lacks lands again.


def _append(records: DataFrame, table: LandedTable) -> bool:
    spark = records.sparkSession
    fresh = unlanded(records, table).persist()
    try:
        days = _days(fresh)
        if not days:
            return False
        ChangedDays(spark, table.path).note(d for d in days if d is not None)
        # Every task holds one bucket or a part of it, so a day gets one file for each.
        fresh.select(*BRONZE_EVENT.columns[:-1], KEY, BRONZE_EVENT.partition).write.mode(
            "append"
        ).insertInto(table.name)
        return True
    finally:
        fresh.unpersist()


def unlanded(records: DataFrame, table: LandedTable) -> DataFrame:
    """One of each record that the landed table does not hold yet, dealt into its buckets or,
    if they are many, into equal parts of them."""
    spark = records.sparkSession
    dated = BRONZE_EVENT.conform(records.withColumn("event_date", event_day()))
    keyed = dated.withColumn(KEY, _identity())
    sizes = _day_sizes(dated)
    days, parts = list(sizes), -(-sum(sizes.values()) // (TASK_BYTES * table.buckets))
    # Of a multiple of the buckets, every part lies in one bucket.
    dealt = table.buckets * max(1, parts)
    fresh = keyed.repartition(dealt, KEY).dropDuplicates([KEY])
    table.see(spark, days)
    touched = F.col("event_date").isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col("event_date").isNull()
    known = spark.table(table.name).where(touched).select(F.col(KEY).alias("_known"))
    if dealt > table.buckets:
        known = known.repartition(dealt, "_known")
    # What is landed grows without bound, so it is never broadcast.
    return fresh.join(known.hint("merge"), fresh[KEY] == known["_known"], "left_anti")


def _days(rows: DataFrame) -> list:
    """The different days, at most as many as the calendar has."""
    return [row[0] for row in rows.select("event_date").distinct().collect()]


def _day_sizes(rows: DataFrame) -> dict[date | None, int]:
    """Bytes by day that the rows take in memory: eight a column, and their strings."""
    strings = [c for c, kind in rows.dtypes if kind == "string"]
    width = reduce(add, [F.coalesce(F.octet_length(c), F.lit(0)) for c in strings])
    sizes = rows.groupBy("event_date").agg(F.sum(width + 8 * len(rows.columns)).alias("size"))
    return {row["event_date"]: row["size"] for row in sizes.collect()}


def _identity() -> Column:
    """What makes a record of a day the same one. Without an id, only an equal record is; the
    day is part of it, so that one column decides. Never null: records without an id spread
    over the buckets by what they hold."""
    content = F.sha2(F.to_json(F.struct(*BRONZE.names)), 256)
    own = F.when(F.col("event_id").isNotNull(), F.concat(F.lit("i"), "event_id")).otherwise(
        F.concat(F.lit("c"), content)
    )
    return F.concat_ws(" ", F.coalesce(F.col("event_date").cast("string"), F.lit("-")), own)


def compact(spark: SparkSession, bronze_path: str, *, most: int = 8) -> list[date | None]:
    """Rewrite every day that has more than `most` files a bucket as one file a bucket.

    Safe beside readers and landing: the copy becomes the day's version at once and whole.
    Who has begun to read the version before can end, as that goes only when the day is next
    compacted. A batch that landed in it after it was copied lands again, by whichever side
    sees it: this one looks again after the switch, landing after its append. Returns the days.
    """
    table, folders = LandedTable.at(spark, bronze_path), Folders(spark)
    done = []
    for day, folder in sorted(table.versions.all_current().items(), key=str):
        before = set(_data_files(folders, folder))
        if len(before) > most * table.buckets:
            _rewrite(spark, table, day, folder, before)
            late = set(_data_files(folders, folder)) - before
            if late:
                rows = spark.read.schema(BRONZE_EVENT.schema).parquet(*[f"{folder}/{f}" for f in late])
                land_batch(rows.select(*BRONZE.names), bronze_path)
            done.append(day)
    return done


def _data_files(folders: Folders, folder: str) -> list[str]:
    return [name for name in folders.names(folder) if not name.startswith(("_", "."))]


def _rewrite(spark: SparkSession, table: LandedTable, day, folder: str, files: set[str]) -> None:
    """One file a bucket out of these files, as the day's next version."""
    run = table.versions.start()
    staging = f"{table.name}_{run.replace('-', '_')}"
    spark.sql(
        f"CREATE TABLE {staging} ({_COLUMNS}) USING PARQUET CLUSTERED BY ({KEY}) "
        f"INTO {table.buckets} BUCKETS LOCATION '{table.versions.folder(day, run)}'"
    )
    try:
        rows = spark.read.schema(spark.table(staging).schema).parquet(*[f"{folder}/{f}" for f in files])
        rows.repartition(table.buckets, KEY).write.insertInto(staging)
    except Exception:
        table.versions.abandon(run)
        raise
    finally:
        spark.sql(f"DROP TABLE {staging}")  # of the catalog; files stay
    table.versions.finish(run, [day])
    table.see(spark, [day])
    # What was current until now stays for those who read it.
    table.versions.prune(folder.rsplit("run=", 1)[1], [day])


def land_stream(
    spark: SparkSession,
    source_path: str,
    bronze_path: str,
    checkpoint: str,
    *,
    max_bytes: int | None = None,
    rejects_path: str | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Land every file that arrived since the last call, then stop.

    Each micro-batch goes through `land_batch`. Without `rejects_path` a malformed line or
    time fails the run. With it such lines go there instead, with their file and the reason,
    one folder for each micro-batch, so that one that runs again sets them aside once; the
    source is read and parsed once for both. `max_bytes` bounds a micro-batch.
    """
    options = {"maxBytesPerTrigger": max_bytes} if max_bytes else {}
    reader = spark.readStream.options(**options)
    if rejects_path is None:
        records = read_records(reader, source_path)
        sink = records.writeStream.foreachBatch(
            lambda rows, _: land_batch(rows, bronze_path, buckets=buckets)
        )
    else:
        lines = split_records(reader, source_path)
        sink = lines.writeStream.foreachBatch(
            lambda rows, number: _land_good(rows, bronze_path, f"{rejects_path}/batch={number}", buckets)
        )
    query = sink.option("checkpointLocation", f"{checkpoint}/records").trigger(availableNow=True)
    query.start().awaitTermination()


def _for_both(lines: DataFrame) -> DataFrame:
    """What is kept of split lines: of a good one its record, of a bad one the line itself."""
    bad = F.col("reason").isNotNull()
    record = F.when(~bad, F.col("record")).alias("record")
    return lines.select(*[F.when(bad, F.col(c)).alias(c) for c in ("line", "file")], record, "reason")


def _land_good(lines: DataFrame, bronze_path: str, rejects_path: str, buckets: int) -> None:
    lines = _for_both(lines).persist()
    try:
        bad = lines.where(F.col("reason").isNotNull()).select("line", "file", "reason")
        bad.write.mode("overwrite").json(rejects_path)
        good = lines.where(F.col("reason").isNull()).select("record.*")
        _land(good.select(*BRONZE.names), bronze_path, buckets)
    finally:
        lines.unpersist()
