"""Threshold alarms on windowed metric sums.

Metric rows are ``ts, namespace, metric, dimension, value``. A window with no rows produces no sum and so
does not breach. The same code runs on a batch frame and on a stream (which needs a watermark on ``ts``,
see :mod:`meterline.streaming.alarms`), rules over several periods in a row included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.config import BRONZE_JOB, GOLD_JOB, SILVER_JOB


@dataclass(frozen=True)
class AlarmRule:
    """Alarm for each listed dimension whose sum over ``period_seconds`` reaches ``threshold``."""

    suffix: str
    namespace: str
    metric: str
    dimensions: tuple[str, ...]
    period_seconds: int
    threshold: float = 1.0
    evaluation_periods: int = 1

    def applies(self) -> Column:
        return (
            (F.col("namespace") == self.namespace)
            & (F.col("metric") == self.metric)
            & F.col("dimension").isin(*self.dimensions)
        )


# Namespaces, metrics, periods and thresholds of the four alarm families.
TASK_FAILURES = AlarmRule(
    "failure-alarm", "Glue", "glue.driver.aggregate.numFailedTasks", (BRONZE_JOB, SILVER_JOB, GOLD_JOB), 300
)
FUNCTION_ERRORS = AlarmRule(
    "error-alarm", "AWS/Lambda", "Errors", ("audit-logger", "notifier", "metadata-validator"), 60
)
AUDIT_ERRORS = AlarmRule("system-errors", "AWS/DynamoDB", "SystemErrors", ("trip-audit",), 60)
RUN_FAILURES = AlarmRule("failed-alarm", "AWS/States", "ExecutionsFailed", ("trip-run",), 60)
ALARM_RULES = (TASK_FAILURES, FUNCTION_ERRORS, AUDIT_ERRORS, RUN_FAILURES)


def window_sums(metrics: DataFrame, period_seconds: int) -> DataFrame:
    """Sum of each metric and dimension per tumbling window ``w``."""
    window = F.window("ts", f"{period_seconds} seconds").alias("w")
    return metrics.groupBy("namespace", "metric", "dimension", window).agg(F.sum("value").alias("total"))


def breaches(sums: DataFrame, rules: Sequence[AlarmRule]) -> DataFrame:
    """``alarm, dimension, w, total`` for each window and each of its rules whose threshold it reaches."""
    matches = F.array_compact(
        F.array(
            *[
                F.when(rule.applies() & (F.col("total") >= rule.threshold), F.concat("dimension", F.lit(f"-{rule.suffix}")))
                for rule in rules
            ]
        )
    )
    return sums.select("dimension", "w", "total", F.explode(matches).alias("alarm"))


def sustained(breached: DataFrame, period_seconds: int, periods: int) -> DataFrame:
    """Windows that end a run of ``periods`` breaching windows in a row.

    A sliding window as long as the run holds so many windows; all of them breach if as many reports fall into it. A
    count per sliding window, so no alarm's history sits in one task, and on a stream a second windowed aggregation over
    the first one's, which the same watermark closes.
    """
    if periods == 1:
        return breached.select("alarm", "dimension", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total")
    run = F.window(F.window_time("w"), f"{period_seconds * periods} seconds", f"{period_seconds} seconds").alias("run")
    return (
        breached.groupBy("alarm", "dimension", run)
        .agg(F.count(F.lit(1)).alias("reports"), F.max(F.struct("w", "total")).alias("last"))
        .where(F.col("reports") == periods)
        .select(
            "alarm", "dimension", F.col("last.w.start").alias("window_start"), F.col("last.w.end").alias("window_end"),
            F.col("last.total").alias("total"),
        )
    )


def rules_by_period(rules: Sequence[AlarmRule]) -> dict[tuple[int, int], list[AlarmRule]]:
    """Rules that share a period and how many of them must breach in a row."""
    groups: dict[tuple[int, int], list[AlarmRule]] = {}
    for rule in rules:
        groups.setdefault((rule.period_seconds, rule.evaluation_periods), []).append(rule)
    return groups


def any_applies(rules: Sequence[AlarmRule]) -> Column:
    return reduce(Column.__or__, [rule.applies() for rule in rules])


def evaluate_alarms(metrics: DataFrame, rules: Sequence[AlarmRule] = ALARM_RULES) -> DataFrame:
    """Every alarm that fires, with the window in which it does: an aggregation for the rules that share a period."""
    fired = []
    for (period, periods), members in rules_by_period(rules).items():
        sums = window_sums(metrics.where(any_applies(members)), period)
        fired.append(sustained(breaches(sums, members), period, periods))
    return reduce(DataFrame.unionByName, fired)
