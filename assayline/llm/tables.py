"""Reading the text tables, row keys and intermediate tables, shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from assayline.session import scratch_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    They need it wherever the driver was started; Spark serves the archive to executors.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="assayline-"), "assayline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed, so other columns cannot clash with working names."""
    return df.select(*[df[name].alias(alias) for alias, name in columns.items()])


def unused(df: DataFrame, name: str) -> str:
    """A column name the table lacks, in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_of(df: DataFrame) -> Column:
    """The whole row as one value, beside which working columns may have any name."""
    return F.struct(*[df[c] for c in df.columns])


def columns_of(df: DataFrame, row: str = "row") -> list[Column]:
    """The columns of `df` out of such a value."""
    return [F.col(row)[c].alias(c) for c in df.columns]


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo a small number; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % divisor


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where `body` uses it in inner lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def holding(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that is computed once for each row, however often it is used: a
    projection would be merged into those that follow and computed in each place anew."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` stored once in the cluster's shared folder and read back.

    Later steps then start from files every executor can reach, whichever of them is lost.
    The shuffle files that led to them go when the write has ended; `forget` removes the
    table itself.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def forget(*tables: DataFrame) -> None:
    """Remove tables that `written` stored and that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def map_rows(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInPandas over rows with a doc_id, which passes as text: a null among whole numbers
    would turn the others into floating-point numbers."""
    texts = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    made = texts.mapInPandas(run, schema.replace("doc_id bigint", "doc_id string"))
    return made.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def with_measure(
    df: DataFrame,
    text: str,
    name: str,
    kind: T.DataType,
    arrow: pa.DataType,
    measure: Callable[[str | None], object],
    at_once: int = 256,
) -> DataFrame:
    """All columns of `df` as they are, and one more made from the text column.

    Rows pass as Arrow; only `at_once` texts at a time become Python objects.
    """
    place = df.columns.index(text)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, at_once):
                part = batch.slice(k, at_once)
                made = [measure(t) for t in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(made, arrow)], names=[*part.schema.names, name]
                )

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))
