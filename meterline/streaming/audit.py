"""Audit records from a stream of stage events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.readwriter import DataStreamWriter

from meterline.operators.audit import parse_run_event
from meterline.sources.control import append_audit, upsert_audit
from meterline.streaming.landing import batch_names, query_id


def stream_audit(events: DataFrame, audit_path: str, checkpoint: str, name: str) -> DataStreamWriter:
    """Appends each micro-batch to the audit log under a batch id of its own.

    A batch that is processed again after a failure replaces its own folder, so no record doubles. A new checkpoint
    is a new query and starts new folders, whatever its name. The query keeps no state: "latest per key" is taken when
    the audit table is read.
    """
    parsed = parse_run_event(events)
    batch_name = batch_names(checkpoint, name)

    def append(batch: DataFrame, number: int) -> None:
        append_audit(batch, audit_path, batch=batch_name(batch, number))

    return parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append)


def stream_audit_table(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Merges each micro-batch into the keyed audit table; see :mod:`meterline.sources.keyed`."""
    parsed = parse_run_event(events)

    def merge(batch: DataFrame, number: int) -> None:
        upsert_audit(batch, path, query_id(batch.sparkSession, checkpoint), number)

    return parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
