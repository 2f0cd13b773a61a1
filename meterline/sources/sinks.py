"""Table writes. An overwrite replaces the whole table unless ``dynamic`` is asked for."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterline.operators.quality import REASON

SILVER_PARTITIONS = ("pickup_year", "pickup_month")
NULL_MARK = "\\N"
REJECT_SALTS = 8
GOLD_WRITERS = 16
# Files of different folders that a task writes side by side. Rows are clustered by month or reason, so few are open.
OPEN_FILES = 32
_OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def without_sort(spark: SparkSession) -> Iterator[None]:
    """Tables written within by folders are not sorted by folder first, which held or spilled all rows of a task.

    A task whose rows go to more than OPEN_FILES folders sorts those that are left.
    """
    before = spark.conf.get(_OPEN_FILES_SETTING, None)
    spark.conf.set(_OPEN_FILES_SETTING, str(OPEN_FILES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_OPEN_FILES_SETTING)
        else:
            spark.conf.set(_OPEN_FILES_SETTING, before)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), dynamic: bool = False) -> None:
    """Parquet overwrite. With ``dynamic`` only the partitions present in ``df`` are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with without_sort(df.sparkSession):
        writer.parquet(path)


def write_bronze(df: DataFrame, path: str) -> None:
    write_table(df, path)


def write_silver(
    df: DataFrame, path: str, dynamic: bool = False, rebalance: bool = False, observation: Observation | None = None
) -> None:
    """Silver by pickup year and month.

    No shuffle by default: files land by month, so a task holds few months and writes few files. Where
    input is not clustered by month, ``rebalance`` brings a month's rows together first; adaptive
    execution then splits a large month over many tasks instead of giving it to one.

    ``observation`` receives the number of ``rows``. It is taken in the tasks that write, where Spark
    counts a partition once however often it is tried.
    """
    if rebalance:
        df = df.hint("rebalance", *SILVER_PARTITIONS)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    write_table(df, path, SILVER_PARTITIONS, dynamic)


def write_reject(
    df: DataFrame,
    path: str,
    always: bool = False,
    observation: Observation | None = None,
    reasons: Sequence[str] = (),
) -> bool:
    """Rejects by reason; says whether anything was written.

    Without rejects nothing is written and an earlier run's rejects stay; ``always`` replaces them.
    Rejects are a minor part of each input file, so every task would add a small file per reason; the
    rebalance merges those. Most rejects tend to share one reason, so each reason is spread over a few
    salts, and adaptive execution splits whatever is still large.

    ``observation`` receives the number of rows for each of ``reasons``, counted as for silver.
    """
    if not always and df.isEmpty():
        return False
    # A hash of the row, not a random number: a task that runs again must send its rows the same way.
    salted = df.withColumn("reject_salt", F.pmod(F.xxhash64(*df.columns), F.lit(REJECT_SALTS)))
    df = salted.hint("rebalance", REASON, "reject_salt").drop("reject_salt")
    if observation is not None:
        df = df.observe(observation, *[F.count_if(F.col(REASON) == reason).alias(reason) for reason in reasons])
    write_table(df, path, (REASON,))
    return True


def write_gold_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), dynamic: bool = False) -> None:
    """A summary table, one file per partition.

    A table by month has a bounded number of months, which a fixed number of tasks writes side by side.
    Other summaries are as long as their key is; adaptive execution sizes their files.
    """
    spread = df.repartition(GOLD_WRITERS, *partition_by) if partition_by else df.hint("rebalance")
    write_table(spread, path, partition_by, dynamic)


def save_query_result(spark: SparkSession, name: str, query: str | DataFrame, folder: str) -> DataFrame:
    """Runs a query, keeps its result as CSV under its name, prints the first rows, and returns it."""
    result = spark.sql(query) if isinstance(query, str) else query
    target = f"{folder.rstrip('/')}/{name}"
    # A null is written as a mark of its own, so that an empty text comes back as one.
    result.write.mode("overwrite").option("header", True).option("nullValue", NULL_MARK).option("emptyValue", '""').csv(target)
    reader = spark.read.schema(result.schema).option("header", True).option("nullValue", NULL_MARK).option("emptyValue", "")
    saved = reader.csv(target)
    print(f"--- {name} ---")
    saved.show(truncate=False)
    return saved
