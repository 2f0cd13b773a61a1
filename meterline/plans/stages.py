"""The layer stages and a run of all of them.

Stages hand data over as stored tables, so each can be run again on its own. A run records its outcome
in the audit log and sends a notice; which comes first depends on the outcome.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterline.config import RUN_JOB, Layout, QualityBounds
from meterline.operators import lineage, quality, shaping, summaries
from meterline.operators.audit import parse_run_event
from meterline.operators.landed_files import validate_files
from meterline.operators.notices import DEFAULT_TITLE, parse_notification
from meterline.sources import catalog, control, manifest, sinks, tables
from meterline.sources.workspace import cut_lineage

logger = logging.getLogger(__name__)

# Source, types and messages of the events that record a run's outcome.
RUN_EVENT_SOURCE = "aws.stepfunctions"
SUCCESS_EVENT = "Pipeline Execution Success"
FAILURE_EVENT = "Pipeline Execution Failure"
NOTICE_EVENT = "Pipeline Notification"
SUCCESS_AUDIT = "All pipeline stages completed successfully"
FAILURE_AUDIT = "Pipeline failed"
SUCCESS_NOTICE = "{title} completed — Bronze → Silver → Gold done"
FAILURE_NOTICE = "{title} FAILED — check logs"


@dataclass(frozen=True)
class SilverReport:
    """Row counts of a silver run: accepted rows, and rejected rows by reason."""

    valid: int
    rejected: dict[str, int]

    @property
    def total(self) -> int:
        return self.valid + sum(self.rejected.values())

    @property
    def rejection_rate(self) -> float:
        return 100.0 * sum(self.rejected.values()) / self.total if self.total else 0.0


def to_bronze(raw: DataFrame) -> DataFrame:
    return raw.transform(lineage.add_ingestion_time).transform(lineage.add_source_file)


def to_silver(bronze: DataFrame, bounds: QualityBounds = QualityBounds()) -> DataFrame:
    rules = quality.trip_rules(bounds)
    tagged = quality.tag_quality(quality.prune_rejects(bronze, rules), rules)
    return quality.valid_rows(tagged).transform(shaping.shape_trips)


def to_rejects(bronze: DataFrame, bounds: QualityBounds = QualityBounds()) -> DataFrame:
    return quality.rejected_rows(quality.tag_quality(bronze, quality.trip_rules(bounds)))


class GoldFrames(dict):
    """Summaries by name, each planned when it is first asked for."""

    def __init__(self, silver: DataFrame) -> None:
        super().__init__()
        self._silver = silver

    def __missing__(self, name: str) -> DataFrame:
        summary = next(one for one in summaries.SUMMARIES if one.name == name)
        self[name] = summaries.summarise(self._silver, summary)
        return self[name]

    def row_counts(self) -> DataFrame:
        """Rows of every summary, from one scan of silver."""
        combined = summaries.summarise_all(self._silver)
        names = [one.name for one in summaries.SUMMARIES]
        counted = combined.agg(*[F.count_if(F.col(summaries.SET_NAME) == name).alias(name) for name in names])
        rows = F.array(*[F.struct(F.lit(name).alias("gold_table"), F.col(name).alias("row_count")) for name in names])
        return counted.select(F.inline(rows))


def to_gold(silver: DataFrame) -> GoldFrames:
    """Each summary as a frame of its own, for questions that need only some of them."""
    return GoldFrames(silver)


def bronze_stage(spark: SparkSession, layout: Layout) -> None:
    bronze = tables.scan_raw(spark, layout.raw, to_bronze)
    logger.info("raw schema: %s", bronze.schema.simpleString())
    sinks.write_bronze(bronze, layout.bronze)


def validated_bronze_stage(spark: SparkSession, layout: Layout, bucket: str) -> DataFrame:
    """Bronze from the files that pass validation, in one write; returns the findings per file.

    Without a valid file it fails and leaves the old bronze alone, so that nothing goes on from an earlier run's data.
    """
    findings = cut_lineage(validate_files(manifest.file_manifest(spark, layout.raw, bucket)))
    sinks.write_bronze(manifest.validated_scan(spark, findings, layout.raw, to_bronze), layout.bronze)
    return findings


def silver_stage(
    spark: SparkSession,
    layout: Layout,
    bounds: QualityBounds = QualityBounds(),
    rebalance: bool = False,
    always_write_rejects: bool = False,
    dynamic: bool = False,
) -> SilverReport:
    """Silver, counted while it is written, then rejects if bronze holds more rows than silver took.

    Bronze is gone through once without rejects and twice with them: its own count comes from the file footers.
    """
    bronze = tables.scan_bronze(spark, layout.bronze)
    reasons = [rule.reason for rule in quality.trip_rules(bounds)]
    written, refused = Observation("silver"), Observation("reject")
    sinks.write_silver(to_silver(bronze, bounds), layout.silver, dynamic, rebalance, written)
    valid = written.get.get("rows", 0)
    rejected: dict[str, int] = {}
    if always_write_rejects or tables.row_count(bronze) > valid:
        rejects = to_rejects(bronze, bounds)
        sinks.write_reject(rejects, layout.reject, always=True, observation=refused, reasons=reasons)
        rejected = {reason: count for reason, count in refused.get.items() if count}

    report = SilverReport(valid, rejected)
    logger.info(
        "silver: valid %d, rejected %d, total %d, rejection rate %.2f%%",
        report.valid, sum(rejected.values()), report.total, report.rejection_rate,
    )
    return report


def gold_stage(spark: SparkSession, layout: Layout) -> None:
    """All four summaries from one scan of silver; only the finished summaries are stored and split."""
    _forget_states(spark, layout)
    combined = cut_lineage(summaries.summarise_all(tables.scan_silver(spark, layout.silver)))
    for summary in summaries.SUMMARIES:
        sinks.write_gold_table(
            summaries.pick_summary(combined, summary), layout.gold_table(summary.name), summary.stored_by
        )


class NoStates(RuntimeError):
    """Months cannot be refreshed, because no run has stored what the other months add."""


def _has_states(spark: SparkSession, layout: Layout) -> bool:
    try:
        spark.read.parquet(layout.gold_states)
    except AnalysisException as error:
        # A folder that is not there, and one that a run without states has emptied.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def in_months(months: Sequence[tuple[int, int]]) -> Column:
    """Whether a row's folder is one of the months; plain comparisons, so that other folders are not opened."""
    year, month = (F.col(name) for name in summaries.MONTH)
    tests = [(year == wanted_year) & (month == wanted_month) for wanted_year, wanted_month in months]
    return reduce(or_, tests, F.lit(False))


def refresh_gold(spark: SparkSession, layout: Layout, months: Sequence[tuple[int, int]] | None = None) -> None:
    """Gold after some months of silver have changed, been added or lost all their trips.

    Only the months named are scanned. What they add to each summary replaces their stored states; tables by month are
    replaced for these months, and tables over all months are merged from all states, which are as long as months times
    keys. Without ``months`` everything is scanned and stored anew, which is how states begin. A refresh that failed on
    its way is mended by doing it again.
    """
    silver = tables.scan_silver(spark, layout.silver)
    if months is None:
        fresh = summaries.month_states(silver)
    elif not _has_states(spark, layout):
        raise NoStates(f"{layout.gold_states}: refresh gold without naming months first")
    else:
        months = sorted(set(months))
        fresh = summaries.month_states(silver.where(in_months(months)), months)
    if months is not None and not months:
        return
    # The states are months times keys, so a month's rows fit one file unless adaptive execution finds them large.
    sinks.write_table(fresh.hint("rebalance", *summaries.MONTH), layout.gold_states, summaries.MONTH, dynamic=months is not None)
    states = spark.read.parquet(layout.gold_states)
    replaceable = months is not None and _all_have_trips(states, months)
    for summary in summaries.SUMMARIES:
        by_month = bool(summary.stored_by) and replaceable
        own = states.where(in_months(months)) if by_month else states
        sinks.write_gold_table(
            summaries.merge_states(own, summary), layout.gold_table(summary.name), summary.stored_by, dynamic=by_month
        )


def _all_have_trips(states: DataFrame, months: Sequence[tuple[int, int]]) -> bool:
    """Whether each month has a row to replace its folder with; where not, the folder goes by writing the whole table."""
    with_trips = states.where(in_months(months) & (F.col(summaries.SET_NAME) != summaries.MONTH_MARK))
    return with_trips.select(*summaries.MONTH).distinct().count() == len(months)


def _forget_states(spark: SparkSession, layout: Layout) -> None:
    """Empties the states, which no longer describe the tables once a run without states has written them."""
    if _has_states(spark, layout):
        states = spark.read.parquet(layout.gold_states)
        sinks.write_table(spark.createDataFrame([], states.schema), layout.gold_states, summaries.MONTH)


def register_tables(spark: SparkSession, layout: Layout, database: str, location: str | None = None) -> DataFrame:
    """Names silver and gold in the catalog and lists what is registered."""
    catalog.create_database(spark, database, location)
    catalog.register_silver(spark, database, layout.silver)
    catalog.register_gold(spark, database, layout.gold)
    return catalog.list_tables(spark, database)


class RunFailed(RuntimeError):
    """A stage failed; the cause is attached."""


@dataclass(frozen=True)
class RunOptions:
    """How a run differs from the plain one.

    ``bucket`` names where files landed and makes bronze from the valid ones only; ``rebalance`` brings a month's silver
    rows together; ``dynamic`` replaces only the months at hand; ``replace_rejects`` writes rejects even if there are
    none; ``database`` registers the tables after gold. ``states`` has gold store what each month adds, so that
    ``refresh_gold`` can bring in single months later.
    """

    bucket: str | None = None
    rebalance: bool = False
    dynamic: bool = False
    replace_rejects: bool = False
    database: str | None = None
    states: bool = False

    def stages(self) -> tuple[Callable[[SparkSession, Layout], object], ...]:
        bronze = bronze_stage if self.bucket is None else partial(validated_bronze_stage, bucket=self.bucket)
        silver = partial(
            silver_stage, rebalance=self.rebalance, dynamic=self.dynamic, always_write_rejects=self.replace_rejects
        )
        return bronze, silver, refresh_gold if self.states else gold_stage


def default_stages() -> tuple[Callable[[SparkSession, Layout], object], ...]:
    return (bronze_stage, silver_stage, gold_stage)


@dataclass
class Run:
    """One execution: its name, when it started, and who hears about it."""

    layout: Layout
    name: str = field(default_factory=lambda: f"run-{_utc_now():%Y%m%d-%H%M%S}")
    started_at: str = field(default_factory=lambda: _iso(_utc_now()))
    title: str = DEFAULT_TITLE
    sender: str | None = None
    recipient: str | None = None


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _iso(moment: dt.datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")


def _event(spark: SparkSession, run: Run, event_type: str, state: str, message: str, with_times: bool) -> DataFrame:
    """The run's outcome as an event; audit events carry times, notices do not."""
    times = [("startedOn", run.started_at), ("completedOn", _iso(_utc_now()))] if with_times else []
    details = [("jobName", RUN_JOB), ("state", state), ("jobRunId", run.name), ("message", message), *times]
    fields = [F.lit(RUN_EVENT_SOURCE).alias("source"), F.lit(event_type).alias("detail-type")]
    if with_times:
        fields.append(F.lit(run.started_at).alias("time"))
    fields.append(F.struct(*[F.lit(value).alias(name) for name, value in details]).alias("detail"))
    return spark.range(1).select(F.to_json(F.struct(*fields)).alias("body"))


def record_audit(spark: SparkSession, run: Run, event_type: str, state: str, message: str) -> None:
    event = _event(spark, run, event_type, state, message, with_times=True)
    control.append_audit(parse_run_event(event), run.layout.audit)


def send_notice(spark: SparkSession, run: Run, state: str, message: str) -> None:
    event = _event(spark, run, NOTICE_EVENT, state, message, with_times=False)
    control.append_notices(
        parse_notification(event), run.layout.notices, run.layout.outbox, run.title, run.sender, run.recipient
    )


def on_success(spark: SparkSession, run: Run) -> None:
    """Audit, then notice. The run has succeeded whatever becomes of them."""
    _attempt(record_audit, spark, run, SUCCESS_EVENT, "SUCCEEDED", SUCCESS_AUDIT)
    _attempt(send_notice, spark, run, "SUCCEEDED", SUCCESS_NOTICE.format(title=run.title))


def on_failure(spark: SparkSession, run: Run) -> None:
    """Notice, then audit; when the notice cannot be sent there is no audit record either."""
    if _attempt(send_notice, spark, run, "FAILED", FAILURE_NOTICE.format(title=run.title)):
        _attempt(record_audit, spark, run, FAILURE_EVENT, "FAILED", FAILURE_AUDIT)


def _attempt(action: Callable[..., None], *arguments: object) -> bool:
    try:
        action(*arguments)
    except Exception:
        logger.exception("%s failed", action.__name__)
        return False
    return True


def run_stages(
    spark: SparkSession,
    run: Run,
    stages: Sequence[Callable[[SparkSession, Layout], object]] | None = None,
    options: RunOptions | None = None,
) -> None:
    """Runs the stages in order and stops at the first that fails; with a database, registers the tables at the end."""
    options = options or RunOptions()
    chosen = list(options.stages() if stages is None else stages)
    if options.database is not None:
        chosen.append(partial(register_tables, database=options.database))
    for stage in chosen:
        try:
            stage(spark, run.layout)
        except Exception as error:
            on_failure(spark, run)
            raise RunFailed(f"{run.name}: {getattr(stage, 'func', stage).__name__} failed") from error
    on_success(spark, run)
