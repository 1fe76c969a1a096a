"""Raw shop records: newline-delimited UTF-8 JSON, and the typed table they land in.

The readers take `spark.read` or `spark.readStream`, so batch and stream parse alike.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from assayline.functions import as_days
from assayline.schemas import BRONZE, BRONZE_EVENT
from assayline.sinks.versions import Versions

_CORRUPT = "_corrupt_record"
_WITH_CORRUPT = T.StructType(BRONZE.fields + [T.StructField(_CORRUPT, T.StringType())])


def read_records(reader, path: str, *, keep_going: bool = False) -> DataFrame:
    """Typed records.

    A malformed line fails the job. With `keep_going` it is left out instead, as is a record
    whose time is malformed, and `read_rejects` returns both.
    """
    if not keep_going:
        return reader.schema(BRONZE).option("mode", "FAILFAST").json(path)
    good = split_records(reader, path).where(F.col("reason").isNull())
    return good.select(*[f"record.{name}" for name in BRONZE.names])


def read_rejects(reader, path: str) -> DataFrame:
    """line, file and reason of the lines that `read_records(..., keep_going=True)` leaves out."""
    return split_records(reader, path).where(F.col("reason").isNotNull()).select("line", "file", "reason")


def split_records(reader, path: str) -> DataFrame:
    """Every line with text: line, file, the record it holds, and the reason it is none.

    Reasons: `malformed`, no JSON object or a field of another type; `time`, a time that is
    no timestamp. Both parts come from one scan.
    """
    lines = reader.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")
    )
    record = F.from_json(
        "line", _WITH_CORRUPT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    at = F.col("record.event_timestamp")
    reason = F.when(F.col("record").isNull() | F.col(f"record.{_CORRUPT}").isNotNull(), "malformed").when(
        at.isNotNull() & at.try_cast("timestamp_ntz").isNull(), "time"
    )
    return lines.where(F.trim("line") != "").withColumn("record", record).withColumn("reason", reason)


def write_records(records: DataFrame, path: str) -> None:
    """Append records as JSON lines, NULL fields spelled out."""
    (
        records.select(*BRONZE.names)
        .write.mode("append")
        .option("ignoreNullFields", "false")
        .json(path)
    )


def read_bronze(
    spark: SparkSession, *paths: str, day: date | str | Iterable[date | str] | None = None
) -> DataFrame:
    """The landed table, from one or more folders. For some days only theirs are listed.

    Days that landing keeps in versions are read from their current ones.
    """
    tables = []
    for path in paths:
        versions = Versions(spark, path.rstrip("/"), BRONZE_EVENT.partition)
        counting = versions.counting()
        if not counting:
            tables += _plain_days(spark, path, day)
            continue
        if day is None:
            folders = versions.all_current().values()
        else:
            folders = filter(None, [versions.current(d, counting) for d in as_days(day)])
        if folders := list(folders):
            rows = spark.read.schema(BRONZE_EVENT.schema).option("basePath", path).parquet(*folders)
            tables.append(rows.select(*BRONZE_EVENT.columns))
    return reduce(DataFrame.unionByName, tables or [spark.createDataFrame([], BRONZE_EVENT.schema)])


def _plain_days(spark: SparkSession, path: str, day) -> list[DataFrame]:
    """Days as folders of files, written by others than landing."""
    reader, tables = spark.read.schema(BRONZE_EVENT.schema), []
    days = [None] if day is None else as_days(day)
    for folder in [path if d is None else f"{path}/event_date={d.isoformat()}" for d in days]:
        try:
            tables.append(reader.option("basePath", path).parquet(folder))
        except AnalysisException as missing:
            # Nothing landed on that day; a folder without any day at all is a mistake.
            if day is None or missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return tables
