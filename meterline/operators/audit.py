"""Run audit: flattening stage events and keeping the latest record per run and event time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import iso_now
from meterline.functions.events import EVENT_FIELDS, event_fields

AUDIT_KEY = ("job_run_id", "event_time")
AUDIT_FIELDS = ("job_name", "state", "message", "started_on", "completed_on", "logged_at")

# Fixed value: how long audit records are kept.
RETENTION_DAYS = 90

# The day a record was logged, by which the stored log is partitioned.
LOGGED_DAY = "logged_day"


def parse_run_event(events: DataFrame, body: str = "body") -> DataFrame:
    """Audit fields of each stage event (JSON text in ``body``); other columns are carried along."""
    return event_fields(events, tuple(EVENT_FIELDS), body)


def stamp_logged(parsed: DataFrame) -> DataFrame:
    """Adds the time the record was logged."""
    return parsed.withColumn("logged_at", iso_now())


def latest_records(log: DataFrame, *order: str | Column) -> DataFrame:
    """The audit table as of now: per key, the record that was written last.

    ``order`` says what "last" means, most significant first; remaining fields break ties so that the
    result is the same on every run. A maximum over a struct combines before the shuffle, unlike a
    ranking window, so a key written over and over moves as one row per task.
    """
    fields = [name for name in AUDIT_FIELDS if name in log.columns]
    record = F.struct(
        *[column.alias(f"order_{position}") for position, column in enumerate(map(_column, order))],
        *[F.col(name) for name in fields],
    )
    return (
        log.groupBy(*AUDIT_KEY)
        .agg(F.max(record).alias("latest"))
        .select(*AUDIT_KEY, *[F.col(f"latest.{name}") for name in fields])
    )


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def within_retention(records: DataFrame, as_of: dt.datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Records logged within ``days`` of ``as_of`` (UTC).

    ``logged_at`` is ISO text in UTC, which sorts as time does, so comparing text keeps the filter one
    the scan can use. The boundary is a whole second, and a record at that second is kept. Where the day of logging is
    a column, as in the stored log, days before the boundary's are not read.
    """
    oldest = as_of - dt.timedelta(days=days)
    kept = records.where(F.col("logged_at") >= oldest.strftime("%Y-%m-%dT%H:%M:%S"))
    return kept.where(F.col(LOGGED_DAY) >= F.lit(oldest.date())) if LOGGED_DAY in records.columns else kept


def status_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("job_name", "state").agg(F.count(F.lit(1)).alias("runs"))
