"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources.workspace import fresh_folder


def stored(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` computed once, written to the shared folder and read back, so that lost executors cost no recompute."""
    folder = fresh_folder(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Rows of whole texts that go to a Python worker at a time, where what is made of them is stored at once.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is stored within gets its texts in batches of BATCH_ROWS at most.

    Executor and Python worker both hold a whole batch, and with ten thousand texts it is much of a small executor.
    """
    before = spark.conf.get(_BATCH_SETTING)
    if 0 < int(before) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def hashed_sample(rows: DataFrame, place: Column, most: int) -> DataFrame:
    """Rows with the smallest ``place``, a 64-bit hash, one for each value of it and at most ``most`` of them.

    Rows beyond a bound on the hash stay out before anything is sorted, so that what reaches the driver does not grow
    with the number of tasks. The bound is set from the number of distinct hashes, as copies count once, and lets so many
    more through than are wanted that it never leaves too few. Rows of the same hash are combined per task.
    """
    distinct = rows.select(place.alias("place")).distinct().count()
    share = min(1.0, (2 * most + 100) / max(distinct, 1))
    bound = min(2**63 - 1, -(2**63) + int(share * 2**64))
    chosen = rows.withColumn("place", place).where(F.col("place") <= F.lit(bound).cast("bigint"))
    others = [name for name in chosen.columns if name != "place"]
    once = chosen.groupBy("place").agg(F.min(F.struct(*others)).alias("row"))
    return once.orderBy("place").limit(most).select("row.*")


def made_in_one_task(rows: DataFrame, order: list[Column], work: Callable[[Iterator], object]) -> object:
    """What ``work`` makes of the record batches of all rows, in this order, in one task; only that comes to the driver.

    For training: the rows must be a bounded sample, and what is made of them small.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(work(batches))], pa.binary())], names=["made"])

    made = rows.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "made binary").first()
    return work(iter(())) if made is None else pickle.loads(made["made"])
