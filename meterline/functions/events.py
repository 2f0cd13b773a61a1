"""JSON event schemas and their flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import iso_now

STAGE_EVENT = (
    "source string, `detail-type` string, time string, "
    "detail struct<jobName: string, state: string, jobRunId: string, message: string, "
    "startedOn: string, completedOn: string>"
)

ARRIVAL_EVENT = (
    "Records array<struct<s3: struct<bucket: struct<name: string>, "
    "object: struct<key: string, size: bigint>>>>"
)


def detail_or(event: str, field: str, default: str) -> Column:
    """A field of the event's detail; a missing one (or an explicit null) becomes ``default``."""
    return F.coalesce(F.col(f"{event}.detail.{field}"), F.lit(default))


# The fields of a stage event: where each stands in the detail, and what stands for a missing one.
EVENT_FIELDS = {
    "job_name": ("jobName", "unknown"),
    "state": ("state", "unknown"),
    "job_run_id": ("jobRunId", "unknown"),
    "message": ("message", ""),
    "started_on": ("startedOn", ""),
    "completed_on": ("completedOn", ""),
}


def event_fields(events: DataFrame, names: tuple[str, ...], body: str = "body") -> DataFrame:
    """The named fields and the time of each stage event (JSON text in ``body``); other columns are carried along."""
    carried = [name for name in events.columns if name != body]
    parsed = events.withColumn("event", F.from_json(body, STAGE_EVENT))
    fields = [detail_or("event", *EVENT_FIELDS[name]).alias(name) for name in names]
    return parsed.select(*carried, *fields, F.coalesce("event.time", iso_now()).alias("event_time"))
