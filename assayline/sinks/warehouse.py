"""Date-partitioned Parquet tables whose partitions are replaced, never appended to.

A replacement is written to fresh folders and then switched to (see `versions`): until the
whole job has succeeded every reader sees the old days, afterwards the new ones.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayline.functions import as_day, as_days
from assayline.schemas import PIPELINE_TABLES, TableSpec
from assayline.sinks.versions import RUN, Versions


class SchemaMismatch(Exception):
    """The catalog has a table of that name with other columns or types."""


class Warehouse:
    """Catalog tables under one root folder, one database per layer."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "shop"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self._unlisted: set[str] = set()
        self._checked: set[str] = set()

    def name(self, spec: TableSpec) -> str:
        return f"{self.prefix}_{spec.layer}.{spec.name}"

    def location(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.layer}/{spec.folder}"

    def versions(self, spec: TableSpec) -> Versions:
        return Versions(self.spark, self.location(spec), spec.partition)

    def create(self, spec: TableSpec) -> None:
        """Create the table if absent, or see that the one of that name has its columns.

        Days already in its folder are registered when the whole table is first read; a daily
        run needs no listing of the other days.
        """
        if self.spark.catalog.tableExists(self.name(spec)):
            self._agree(spec)
            return
        columns = ", ".join(f"{name} {kind}" for name, kind in spec.fields)
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.prefix}_{spec.layer} "
            f"LOCATION '{self.root}/{spec.layer}'"
        )
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(spec)} ({columns}, {spec.partition} date) "
            f"USING PARQUET OPTIONS (compression 'snappy') "
            f"PARTITIONED BY ({spec.partition}) LOCATION '{self.location(spec)}'"
        )
        self._checked.add(self.name(spec))
        self._unlisted.add(self.name(spec))

    def create_all(self) -> None:
        for spec in PIPELINE_TABLES:
            self.create(spec)

    def _agree(self, spec: TableSpec) -> None:
        """The catalog's columns against the declared ones, before any data is touched.

        Columns that the table lacks are added, null in what is stored; another type, order,
        partition or a column too many is an error.
        """
        if self.name(spec) in self._checked:
            return
        found = [(c.name, c.dataType) for c in self.spark.catalog.listColumns(self.name(spec))]
        parts = [c.name for c in self.spark.catalog.listColumns(self.name(spec)) if c.isPartition]
        stored, declared = found[: len(found) - len(parts)], list(spec.fields)
        if parts != [spec.partition] or stored != declared[: len(stored)]:
            raise SchemaMismatch(
                f"{self.name(spec)} has {found}, partitioned by {parts}; "
                f"declared are {declared}, partitioned by {spec.partition}"
            )
        if more := declared[len(stored) :]:
            added = ", ".join(f"{name} {kind}" for name, kind in more)
            self.spark.sql(f"ALTER TABLE {self.name(spec)} ADD COLUMNS ({added})")
        self._checked.add(self.name(spec))

    def read(
        self, spec: TableSpec, day: date | str | Iterable[date | str] | None = None
    ) -> DataFrame:
        """The table; with days, registered for at least these."""
        if self.name(spec) in self._unlisted:
            versions = self.versions(spec)
            if day is None:
                self._register(spec, versions.all_current())
                self._unlisted.discard(self.name(spec))
            else:
                current = {d: versions.current(d) for d in as_days(day)}
                self._register(spec, {d: folder for d, folder in current.items() if folder})
        return self.spark.table(self.name(spec))

    def _register(self, spec: TableSpec, folders: dict[date, str]) -> None:
        """Make the catalog read these days from these folders."""
        if not folders:
            return
        name, places = self.name(spec), dict(folders)
        known = {row[0].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}

        def part(day: date) -> str:
            return f"PARTITION ({spec.partition} = DATE'{day.isoformat()}')"

        fresh = [d for d in places if d.isoformat() not in known]
        if fresh:
            added = " ".join(f"{part(d)} LOCATION '{places[d]}'" for d in fresh)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
        for d in places.keys() - set(fresh):
            self.spark.sql(f"ALTER TABLE {name} {part(d)} SET LOCATION '{places[d]}'")
        self.spark.catalog.refreshTable(name)

    def replace_day(self, spec: TableSpec, rows: DataFrame, day: date | str) -> None:
        """Make `rows`, all of one day, the whole content of that day. No rows empty it."""
        self._replace(spec, rows.withColumn(spec.partition, F.lit(as_day(day))), [as_day(day)])

    def replace_days(
        self, spec: TableSpec, rows: DataFrame, days: Iterable[date | str], by_day: bool = False
    ) -> None:
        """Make `rows` the whole content of these days, in one job; days they have no rows of
        become empty. Rows of other days are left out, and these days stay."""
        days = as_days(days)
        self._replace(spec, rows.where(F.col(spec.partition).isin(days)), days, by_day)

    def replace_all(self, spec: TableSpec, rows: DataFrame, by_day: bool = False) -> None:
        """Make `rows` the whole content of the table.

        `by_day` tells that the rows are read from files of one day each, so that they can be
        written where they are, without a shuffle.
        """
        self._replace(spec, rows.where(F.col(spec.partition).isNotNull()), None, by_day)

    def _replace(self, spec, rows, days: list[date] | None, by_day: bool = False) -> None:
        if days == []:
            return
        if self.spark.catalog.tableExists(self.name(spec)):
            self._agree(spec)
        versions = self.versions(spec)
        run = versions.start()
        sized = spec.conform(rows) if by_day else self._sized(spec, rows, one_day=days and len(days) == 1)
        try:
            (
                sized.withColumn(RUN, F.lit(run))
                .write.mode("append")
                .partitionBy(spec.partition, RUN)
                .parquet(self.location(spec))
            )
        except Exception:
            versions.abandon(run)
            raise
        folders = versions.finish(run, days)
        self._register(spec, folders)
        versions.prune(run, folders)

    def _sized(self, spec: TableSpec, rows: DataFrame, one_day: bool = False) -> DataFrame:
        """Few, evenly sized files per day.

        Many days are rebalanced on the date: small ones merge, one with most of the rows is
        split. One day needs no key. Silver rows of a day stay where they were read, as
        landed records lie by day already.
        """
        rows = spec.conform(rows)
        if one_day:
            return rows if spec.layer == "silver" and not spec.rollup else rows.hint("rebalance")
        return rows.hint("rebalance", spec.partition)
