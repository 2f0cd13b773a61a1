"""Stored control records: the audit log, the notice log and the outbox.

All three are append-only Parquet folders with one sub-folder per write, ``batch=<id>``. Writing a batch
again replaces its own folder only, so a write repeated after a lost executor or a restarted stream
leaves one copy. The audit table is the log seen through "latest record per key"; nothing is rewritten
when a key is written again.

Beside the log, :func:`upsert_audit` keeps the table itself: merged by key, so that reading it shuffles nothing and
reading one record opens one bucket.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.audit import AUDIT_KEY, LOGGED_DAY, RETENTION_DAYS, latest_records, stamp_logged, within_retention
from meterline.operators.notices import notification_log, notification_outbox, render_notification
from meterline.sources.keyed import KeyedTable

AUDIT_LOG_SCHEMA = (
    "job_run_id string, event_time string, job_name string, state string, message string, "
    "started_on string, completed_on string, logged_at string, sequence bigint, batch string, logged_day date"
)
_AUDIT_COLUMNS = [field.split()[0] for field in AUDIT_LOG_SCHEMA.split(", ") if not field.startswith("batch ")]


def _write_batch(df: DataFrame, path: str, batch: str | None, partition_by: tuple[str, ...] = ()) -> None:
    folder = f"{path.rstrip('/')}/batch={batch or uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def append_audit(parsed: DataFrame, path: str, batch: str | None = None) -> None:
    """Logs parsed stage events. An optional ``sequence`` column orders records logged together."""
    stamped = stamp_logged(parsed)
    if "sequence" not in stamped.columns:
        stamped = stamped.withColumn("sequence", F.lit(0).cast("bigint"))
    dated = stamped.withColumn(LOGGED_DAY, F.to_date(F.left("logged_at", F.lit(10))))
    _write_batch(dated.select(*_AUDIT_COLUMNS), path, batch, (LOGGED_DAY,))


def audit_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_LOG_SCHEMA).parquet(path)


def compact_audit(spark: SparkSession, path: str, target: str, as_of: dt.datetime, days: int = RETENTION_DAYS) -> None:
    """Writes to ``target`` a log that shows the same audit table in one batch, without records past their retention.

    The old log is left as it is; whoever owns it switches to ``target`` and removes the old folder.
    """
    kept = within_retention(audit_log(spark, path), as_of, days)
    latest = latest_records(kept, "logged_at", "sequence").withColumn("sequence", F.lit(0).cast("bigint"))
    dated = latest.withColumn(LOGGED_DAY, F.to_date(F.left("logged_at", F.lit(10))))
    _write_batch(dated.select(*_AUDIT_COLUMNS).hint("rebalance", LOGGED_DAY), target, "compacted", (LOGGED_DAY,))


def audit_table(spark: SparkSession, path: str) -> DataFrame:
    """Latest record per run and event time."""
    return latest_records(audit_log(spark, path), "logged_at", "sequence")


def keyed_audit(path: str) -> KeyedTable:
    """The audit table merged by run and event time; a record logged later wins, then the one with the later sequence."""
    columns = ", ".join(part for part in AUDIT_LOG_SCHEMA.split(", ") if part.split()[0] not in ("batch", LOGGED_DAY))
    return KeyedTable(path, columns, AUDIT_KEY, ("logged_at", "sequence"))


def upsert_audit(parsed: DataFrame, path: str, writer: str, number: int) -> bool:
    """Merges parsed stage events into the audit table; a writer's batch that comes again changes nothing."""
    stamped = stamp_logged(parsed)
    if "sequence" not in stamped.columns:
        stamped = stamped.withColumn("sequence", F.lit(0).cast("bigint"))
    return keyed_audit(path).merge(stamped, writer, number)


def append_notices(
    parsed: DataFrame,
    log_path: str,
    outbox_path: str,
    title: str,
    sender: str | None = None,
    recipient: str | None = None,
    batch: str | None = None,
) -> None:
    """Logs notices by day, then puts them in the outbox."""
    batch = batch or uuid.uuid4().hex
    _write_batch(notification_log(parsed), log_path, batch, ("stream",))
    outbox = notification_outbox(render_notification(parsed, title), sender, recipient)
    _write_batch(outbox, outbox_path, batch)
