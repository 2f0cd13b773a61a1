"""Table scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.config import LANDING_PREFIX
from meterline.sources import manifest
from meterline.sources.workspace import cut_lineage

# What Spark names the failure to bring files under one schema.
MERGE_FAILURES = {"CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE"}


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All Parquet under ``path``; partition folders become columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _conditions(thrown) -> Iterator[str]:
    """The error conditions of a Java exception and its causes; a merge may fail in a task, below the job's failure."""
    while thrown is not None:
        if thrown.getClass().getName() == "org.apache.spark.SparkException":
            yield thrown.getCondition()
        thrown = thrown.getCause()


def scan_raw(spark: SparkSession, path: str, each: Callable[[DataFrame], DataFrame] = manifest.as_it_is) -> DataFrame:
    """Every landed month under the declared schema: columns a month lacks are null, further ones are kept.

    ``each`` is applied where a row still knows its file.

    Where months have a column in types that do not merge (a whole-number column that became a double, say), files
    are grouped by their own types, each group is read as it is and brought to the declared types.
    """
    try:
        merged = spark.read.option("mergeSchema", True).parquet(path)
    except Py4JJavaError as error:
        if not MERGE_FAILURES & set(_conditions(error.java_exception)):
            raise
        files = cut_lineage(manifest.with_footers(manifest.list_files(spark, path).where(F.col("path").endswith(".parquet"))))
        if unreadable := files.where("columns IS NULL").first():
            raise ValueError(f"{unreadable.path}: {unreadable.read_error}") from error
        return manifest.scan_files(spark, files, path, each)
    return each(manifest.conform(merged))


def scan_bronze(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path)


def scan_silver(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path)


def month_folder(root: str, year: int = 2024, month: int = 1) -> str:
    """Where a month's file lands."""
    return f"{root.rstrip('/')}/{LANDING_PREFIX}year={year:04d}/month={month:02d}"


def landing_month(raw: DataFrame, year: int = 2024, month: int = 1) -> DataFrame:
    """One landed month; the filter is on partition folders, so other months are not opened."""
    return raw.where((F.col("year") == year) & (F.col("month") == month))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: its place, name and type, and how many rows have a value in it, from one pass."""
    fields = df.schema.fields
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(f"`{field.name}`").alias(f"filled_{n}") for n, field in enumerate(fields)])
    described = F.array(
        *[
            F.struct(
                F.lit(n).alias("position"), F.lit(field.name).alias("name"), F.lit(field.dataType.simpleString()).alias("type"),
                F.col(f"filled_{n}").alias("filled"), F.col("rows"),
            )
            for n, field in enumerate(fields)
        ]
    )
    return counted.select(F.inline(described))


def row_count(df: DataFrame) -> int:
    """Rows of a table. A bare Parquet scan is counted from the file footers."""
    return df.count()
