"""Quality split of arriving trips into silver and rejects, and the counts of each micro-batch."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from meterline.config import QualityBounds
from meterline.operators import quality
from meterline.plans.stages import SilverReport, to_rejects, to_silver
from meterline.sources import sinks
from meterline.streaming.landing import batch_names

logger = logging.getLogger(__name__)

OBSERVED = "dq"


def counted(bronze: DataFrame, bounds: QualityBounds = QualityBounds()) -> DataFrame:
    """Names the counts of accepted and rejected rows that come with every micro-batch, from the tasks that read it.

    Columns and rows stay as they are. A row's reason is found once, in a column of its own: observed expressions run
    outside generated code and share nothing, so each count would go through all rules again.
    """
    rules = quality.trip_rules(bounds)
    reason = "counted_reason"
    while reason in bronze.columns:
        reason += "_"
    counts = [F.count_if(F.col(reason) == rule.reason).alias(rule.reason) for rule in rules]
    tagged = bronze.withColumn(reason, quality.reject_reason(rules))
    return tagged.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), *counts).drop(reason)


class SplitCounts(StreamingQueryListener):
    """Collects and logs the counts of :func:`quality_split`, a report per micro-batch.

    Spark reports a batch when it is done; a batch that is tried again replaces its report. ``names`` limits the reports
    to queries of these names.
    """

    def __init__(self, names: tuple[str, ...] = (), on_report: Callable[[int, SilverReport], None] | None = None) -> None:
        self.reports: dict[tuple[str, int], SilverReport] = {}
        self._names, self._on_report = names, on_report

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        found = progress.observedMetrics.get(OBSERVED)
        if found is None or (self._names and progress.name not in self._names) or not found["rows"]:
            return
        counts = found.asDict()
        rows = counts.pop("rows")
        rejected = {reason: count for reason, count in counts.items() if count}
        report = SilverReport(rows - sum(rejected.values()), rejected)
        self.reports[str(progress.id), progress.batchId] = report
        logger.info(
            "batch %d: valid %d, rejected %d, total %d, rejection rate %.2f%%, by reason %s",
            progress.batchId, report.valid, report.total - report.valid, report.total, report.rejection_rate, rejected,
        )
        if self._on_report is not None:
            self._on_report(progress.batchId, report)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def total(self) -> SilverReport:
        """All batches together."""
        valid, rejected = 0, {}
        for report in self.reports.values():
            valid += report.valid
            for reason, count in report.rejected.items():
                rejected[reason] = rejected.get(reason, 0) + count
        return SilverReport(valid, rejected)


def watch_counts(spark: SparkSession, *names: str) -> SplitCounts:
    """A listener for the queries of these names, or of all; ``spark.streams.removeListener`` ends it."""
    listener = SplitCounts(names)
    spark.streams.addListener(listener)
    return listener


def quality_split(
    bronze: DataFrame, silver_path: str, reject_path: str, checkpoint: str, bounds: QualityBounds = QualityBounds()
) -> DataStreamWriter:
    """One stateless query that writes both tables, a folder per micro-batch (``batch=<id>``) in each.

    A batch that is tried again replaces its own folders, so no row doubles or is missing in one of the tables. Silver
    rows move nowhere; rejects are brought together by reason, so a batch leaves a file set per reason and not one per
    task. Its counts reach a listener; see :func:`watch_counts`.
    """
    batch_name = batch_names(checkpoint, "split")

    def split(batch: DataFrame, number: int) -> None:
        folder = f"batch={batch_name(batch, number)}"
        # The batch is read once for both tables; lost blocks are read again from its files.
        batch.persist()
        try:
            sinks.write_silver(to_silver(batch, bounds), f"{silver_path.rstrip('/')}/{folder}")
            sinks.write_reject(to_rejects(batch, bounds), f"{reject_path.rstrip('/')}/{folder}", always=True)
        finally:
            batch.unpersist()

    return counted(bronze, bounds).writeStream.option("checkpointLocation", checkpoint).foreachBatch(split)
