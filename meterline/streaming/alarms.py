"""Alarms on a metric stream.

:func:`stream_alarms` appends alarms once the watermark has passed their window; what it says is final.
:func:`stream_window_sums` keeps a table of window sums that each micro-batch brings up to date, over which
:func:`fired_alarms` answers at any time, so an alarm is there with the batch that reaches its threshold and rows that
come late within the watermark still count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from meterline.operators.alarms import ALARM_RULES, AlarmRule, any_applies, breaches, evaluate_alarms, rules_by_period, sustained, window_sums
from meterline.sources.keyed import KeyedTable
from meterline.streaming.landing import query_id, to_table

WATERMARK = "10 minutes"

_FIRED = "alarm string, dimension string, window_start timestamp, window_end timestamp, total double"
_WINDOW = "struct<start: timestamp, end: timestamp>"
_SUMS = f"namespace string, metric string, dimension string, period_seconds int, w {_WINDOW}, total double, batch bigint"


def _timed(metrics: DataFrame, watermark: str) -> DataFrame:
    return metrics.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)


def stream_alarms(
    metrics: DataFrame, path: str, checkpoint: str, rules: Sequence[AlarmRule] = ALARM_RULES, watermark: str = WATERMARK
) -> list[DataStreamWriter]:
    """Alarms as their windows close; state holds sums of windows newer than the watermark only.

    Rules over several periods are a second windowed aggregation over the first one's windows. One query for the rules
    that share a period and a number of periods: in a union of chains of unlike length Spark 4.1 passes the watermark on
    a batch late, and rows of the second aggregation are dropped. Read the alarms with :func:`closed_alarms`.
    """
    timed = _timed(metrics, watermark)
    return [
        to_table(
            evaluate_alarms(timed, members),
            f"{path.rstrip('/')}/period={period}/periods={periods}",
            f"{checkpoint.rstrip('/')}/period={period}/periods={periods}",
        )
        for (period, periods), members in rules_by_period(rules).items()
    ]


def closed_alarms(spark: SparkSession, path: str) -> DataFrame:
    """Alarms of :func:`stream_alarms`."""
    return spark.read.schema(_FIRED).parquet(f"{path.rstrip('/')}/period=*/periods=*")


def window_sum_table(path: str) -> KeyedTable:
    return KeyedTable(path, _SUMS, ("namespace", "metric", "dimension", "period_seconds", "w"), ("batch",))


def stream_window_sums(
    metrics: DataFrame, path: str, checkpoint: str, rules: Sequence[AlarmRule] = ALARM_RULES, watermark: str = WATERMARK
) -> list[DataStreamWriter]:
    """Sums of open windows, merged into a table with each micro-batch; one query for each period among the rules.

    A query's folder of progress and of sums is named after its period. A batch that is tried again changes nothing.
    """
    timed = _timed(metrics, watermark)
    writers = []
    for period in sorted({rule.period_seconds for rule in rules}):
        members = [rule for rule in rules if rule.period_seconds == period]
        sums = window_sums(timed.where(any_applies(members)), period)
        table, progress = window_sum_table(f"{path.rstrip('/')}/period={period}"), f"{checkpoint.rstrip('/')}/period={period}"

        def merge(batch: DataFrame, number: int, table: KeyedTable = table, progress: str = progress, period: int = period) -> None:
            rows = batch.withColumn("period_seconds", F.lit(period)).withColumn("batch", F.lit(number).cast("bigint"))
            table.merge(rows, query_id(batch.sparkSession, progress), number)

        writers.append(sums.writeStream.outputMode("update").option("checkpointLocation", progress).foreachBatch(merge))
    return writers


def fired_alarms(spark: SparkSession, path: str, rules: Sequence[AlarmRule] = ALARM_RULES) -> DataFrame:
    """Alarms that the sums known by now fire."""
    fired = []
    for (period, periods), members in rules_by_period(rules).items():
        sums = window_sum_table(f"{path.rstrip('/')}/period={period}").read(spark).where(any_applies(members))
        if periods > 1:
            # A stored window is a plain struct; a run is looked for over windows.
            sums = sums.groupBy("namespace", "metric", "dimension", F.window("w.start", f"{period} seconds").alias("w")).agg(
                F.first("total").alias("total")
            )
        fired.append(sustained(breaches(sums, members), period, periods))
    return reduce(DataFrame.unionByName, fired)
