"""Pickup of landed files as arrival events name them.

An event may come twice, late, or name a file that is not there or not fit. Repeats that come soon after each other are
dropped by key within the watermark, which bounds the state; a ledger of all files ever judged, merged by key, keeps out
those that come later. A micro-batch reads the footers of its new files, judges them, writes the valid ones to bronze and
the findings beside it, each into a folder of the batch, and enters the files in the ledger last. A batch that is tried
again writes the same folders anew and finds its own files in the ledger as its own, so bronze holds each valid file once.

A file that lands again under the same key is the same file here.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from meterline.operators.landed_files import explode_arrivals, validate_files
from meterline.plans.stages import to_bronze
from meterline.sources import manifest
from meterline.sources.keyed import KeyedTable
from meterline.sources.sinks import write_table
from meterline.sources.workspace import cut_lineage
from meterline.streaming.landing import batch_names, query_id

# How long after an event a repeat of it is told by the stream itself.
WATERMARK = "1 hour"

_FINDINGS = (
    "bucket string, key string, size bigint, n_rows bigint, errors array<string>, is_valid boolean, validated_at string, batch string"
)


def ledger(path: str) -> KeyedTable:
    """Which files were judged, in which batch, and whether they were taken."""
    return KeyedTable(path, "bucket string, key string, is_valid boolean, batch string", ("bucket", "key"), ("batch",))


def new_files(batch: DataFrame, taken: KeyedTable, batch_name: str) -> DataFrame:
    """Files of a micro-batch that no other batch has judged: ``bucket, key, size``, once each."""
    files = batch.groupBy("bucket", "key").agg(F.max("size").alias("size")).where(F.col("key").isNotNull())
    known = taken.touched_by(files).where(F.col("batch") != batch_name).select(
        F.col("bucket").alias("known_bucket"), F.col("key").alias("known_key")
    )
    same = F.col("bucket").eqNullSafe(F.col("known_bucket")) & F.col("key").eqNullSafe(F.col("known_key"))
    return files.join(known, same, "left_anti")


def judged(files: DataFrame, root: str) -> DataFrame:
    """The findings on files named by events, whose contents are under ``root``."""
    base = root.rstrip("/")
    named = files.withColumn("path", F.concat(F.lit(f"{base}/"), F.col("key")))
    footers = manifest.with_footers(named, may_be_gone=True).drop("size")
    return validate_files(named.join(footers, "path"))


def stream_arrivals(
    events: DataFrame, root: str, bronze: str, findings: str, ledger_path: str, checkpoint: str,
    body: str = "body", watermark: str = WATERMARK,
) -> DataStreamWriter:
    """Bronze from the valid files that arrival events (JSON text in ``body``) name.

    The time that counts for repeats is when an event is read, so an event that comes late is not lost.
    """
    timed = events.withColumn("read_at", F.current_timestamp()).withWatermark("read_at", watermark)
    arrivals = explode_arrivals(timed, body, ("read_at",)).dropDuplicatesWithinWatermark(["bucket", "key"]).drop("read_at")
    taken, batch_name = ledger(ledger_path), batch_names(checkpoint, "arrivals")

    def pick_up(batch: DataFrame, number: int) -> None:
        name = batch_name(batch, number)
        found = cut_lineage(judged(new_files(batch, taken, name), root).withColumn("batch", F.lit(name)))
        valid = found.where("is_valid").select("path", "columns", "types")
        if not valid.isEmpty():
            rows = manifest.scan_files(batch.sparkSession, valid, root, to_bronze)
            write_table(rows, f"{bronze.rstrip('/')}/batch={name}")
        write_table(found.select(*_finding_columns()), f"{findings.rstrip('/')}/batch={name}")
        taken.merge(found.select("bucket", "key", "is_valid", "batch"), query_id(batch.sparkSession, checkpoint), number)

    return arrivals.writeStream.option("checkpointLocation", checkpoint).foreachBatch(pick_up)


def _finding_columns() -> list[str]:
    return [part.split()[0] for part in _FINDINGS.split(", ") if part.split()[0] != "batch"]


def arrived(spark: SparkSession, bronze: str) -> DataFrame:
    """Bronze rows of all batches."""
    return spark.read.option("mergeSchema", True).parquet(bronze).drop("batch")


def arrival_findings(spark: SparkSession, findings: str) -> DataFrame:
    """The findings on every file, with the batch that judged it."""
    try:
        return spark.read.schema(_FINDINGS).parquet(findings)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FINDINGS)
