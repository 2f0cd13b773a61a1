"""Content-based routing of stage events: which rules each event matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.config import (
    FAILURE_STATES,
    GOLD_JOB,
    STAGE_EVENT_SOURCE,
    STAGE_EVENT_TYPE,
    SUCCESS_STATES,
)
from meterline.functions.events import STAGE_EVENT


def open_events(events: DataFrame, body: str = "body") -> DataFrame:
    """Parses the JSON text once, so that all rules look at the same struct column ``event``."""
    return events.withColumn("event", F.from_json(body, STAGE_EVENT))


def _is_stage_event() -> Column:
    return (F.col("event.source") == STAGE_EVENT_SOURCE) & (F.col("event.`detail-type`") == STAGE_EVENT_TYPE)


def succeeded() -> Column:
    return _is_stage_event() & F.col("event.detail.state").isin(*SUCCESS_STATES)


def failed() -> Column:
    return _is_stage_event() & F.col("event.detail.state").isin(*FAILURE_STATES)


def completed(last_job: str = GOLD_JOB) -> Column:
    return succeeded() & (F.col("event.detail.jobName") == last_job)


def route_events(opened: DataFrame, last_job: str = GOLD_JOB) -> DataFrame:
    """One row per event and matching rule; an event no rule matches gives none. Works on streams."""
    rules = {"success": succeeded(), "failure": failed(), "complete": completed(last_job)}
    matched = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return opened.withColumn("rule", F.explode(matched))


def _route(opened: DataFrame, rule: str, last_job: str = GOLD_JOB) -> DataFrame:
    """Events of one rule. The rules are made rows first, so that no filter is pushed below the one parse."""
    return route_events(opened, last_job).where(F.col("rule") == rule).drop("rule")


def route_success(opened: DataFrame) -> DataFrame:
    return _route(opened, "success")


def route_failure(opened: DataFrame) -> DataFrame:
    return _route(opened, "failure")


def route_complete(opened: DataFrame, last_job: str = GOLD_JOB) -> DataFrame:
    return _route(opened, "complete", last_job)
