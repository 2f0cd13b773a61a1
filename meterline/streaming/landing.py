"""Arrival-driven pickup of landed files."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

# Files taken per micro-batch, which bounds what one batch holds however many files have landed.
FILES_PER_TRIGGER = 1_000


def stream_landing(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = FILES_PER_TRIGGER, **options: str
) -> DataFrame:
    """New Parquet files under ``path`` as they land; ``schema`` includes the partition columns."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.options(**options).parquet(path)


def to_table(stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> DataStreamWriter:
    """An append to a Parquet table, exactly once per input file."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that has this checkpoint; Spark writes it there before the first batch."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(line.value for line in lines))["id"]


def batch_names(checkpoint: str, name: str) -> Callable[[DataFrame, int], str]:
    """Names for micro-batches, the same whenever a batch is tried again and never those of another query."""
    known: list[str] = []

    def name_of(batch: DataFrame, number: int) -> str:
        if not known:
            known.append(query_id(batch.sparkSession, checkpoint))
        return f"{name}-{known[0]}-{number}"

    return name_of


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Processes everything that is there now, then stops; an error in the stream is raised here."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
