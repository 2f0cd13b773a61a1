"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.functions.exact import round_cents

# Fixed value: timestamps in events and logs are ISO-8601 in UTC with microseconds and offset.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Minutes from ``start`` to ``end`` to two decimals; both ends count in whole seconds."""
    return round_cents((F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0))


def iso_now() -> Column:
    """The query's start time as ISO text in UTC, whatever the session time zone."""
    utc_now = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(utc_now, ISO_UTC)
