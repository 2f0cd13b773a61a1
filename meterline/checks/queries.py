"""The operators as queries ``(spark, sf_dir) -> DataFrame`` over the given tables.

Columns that hold a load time or a path are left out or turned into a yes/no, since no SQL can repeat
them. Queries about storage write to a folder of their own and return what they read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.config import FAILURE_STATES, LANDING_PREFIX, REQUIRED_COLUMNS, Layout
from meterline.operators import alarms, audit, landed_files, lineage, notices, patterns, quality, routing, shaping, summaries
from meterline.plans import analytics, stages
from meterline.sources import adapters, catalog, control, manifest, sinks, stores, tables
from meterline.sources.adapters import table
from meterline.sources.workspace import fresh_folder
from meterline.streaming.alarms import closed_alarms, fired_alarms, stream_alarms, stream_window_sums
from meterline.streaming.arrivals import arrival_findings, arrived, stream_arrivals
from meterline.streaming.audit import stream_audit as start_audit
from meterline.streaming.audit import stream_audit_table as start_audit_table
from meterline.streaming.landing import run_available, stream_landing as landing_stream, to_table
from meterline.streaming.quality_split import quality_split

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TRIP_COLUMNS = [*REQUIRED_COLUMNS, "tolls_amount"]
LANDED_COLUMNS = [*TRIP_COLUMNS, "year", "month"]
DATE_PARTS = ["pickup_date", "pickup_year", "pickup_month", "pickup_hour", "pickup_dayofweek"]
SILVER_COLUMNS = [*LANDED_COLUMNS, *DATE_PARTS, "trip_duration_minutes"]
AUDIT_COLUMNS = ["job_run_id", "event_time", "job_name", "state", "message", "started_on", "completed_on"]


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


# --- inputs -------------------------------------------------------------------------------------------


_landings: dict[tuple[str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake whose landing folder holds the trips by month; its other layers are still empty.

    The landed files stand in for the input a user has, so a session writes them once; layers are per call.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        root = fresh_folder(spark, "landing")
        land(adapters.trips(table(spark, sf_dir, "lineitem")), root)
        _landings[key] = root
    layers = Layout.under(fresh_folder(spark, "lake"))
    return Layout(**{**vars(layers), "raw": _landings[key]})


def land(trips: DataFrame, root: str, mode: str = "overwrite") -> None:
    writer = trips.hint("rebalance", "year", "month").write.mode(mode).partitionBy("year", "month")
    with sinks.without_sort(trips.sparkSession):
        writer.parquet(f"{root}/raw/yellow_tripdata")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips, read from their landed files."""
    return tables.scan_raw(spark, landed(spark, sf_dir).raw)


def bronze_lake(spark: SparkSession, sf_dir: str) -> Layout:
    layout = landed(spark, sf_dir)
    stages.bronze_stage(spark, layout)
    return layout


def silver_lake(spark: SparkSession, sf_dir: str) -> Layout:
    layout = bronze_lake(spark, sf_dir)
    stages.silver_stage(spark, layout)
    return layout


def gold_lake(spark: SparkSession, sf_dir: str) -> Layout:
    layout = silver_lake(spark, sf_dir)
    stages.gold_stage(spark, layout)
    return layout


def registered_lake(spark: SparkSession, sf_dir: str) -> tuple[Layout, str]:
    layout = gold_lake(spark, sf_dir)
    database = new_database(spark)
    stages.register_tables(spark, layout, database, fresh_folder(spark, "database"))
    return layout, database


def new_database(spark: SparkSession) -> str:
    return f"trips_{uuid.uuid4().hex}"


def tagged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.tag_quality(raw_trips(spark, sf_dir))


def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_rows(tagged_trips(spark, sf_dir))


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.to_silver(raw_trips(spark, sf_dir))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.run_events(table(spark, sf_dir, "events"))


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.metrics(table(spark, sf_dir, "events"))


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.manifest(table(spark, sf_dir, "documents"))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table as a stream of files."""
    schema = table(spark, sf_dir, name).schema
    return landing_stream(spark, sf_dir, schema, pathGlobFilter=f"{name}.parquet")


def month_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


def counts_by_table(spark: SparkSession, database: str, names: list[str]) -> DataFrame:
    counts = [
        spark.table(f"`{database}`.`{name}`").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name in names
    ]
    return reduce(DataFrame.unionAll, counts)


# --- scans, sinks, catalog ------------------------------------------------------------------------------


@query("scan_raw")
def _(spark, sf_dir):
    return raw_trips(spark, sf_dir).select(LANDED_COLUMNS)


@query("scan_bronze")
def _(spark, sf_dir):
    return tables.scan_bronze(spark, bronze_lake(spark, sf_dir).bronze).select(LANDED_COLUMNS)


@query("scan_silver")
def _(spark, sf_dir):
    return tables.scan_silver(spark, silver_lake(spark, sf_dir).silver).select(SILVER_COLUMNS)


@query("landing_month")
def _(spark, sf_dir):
    return tables.landing_month(raw_trips(spark, sf_dir)).select(LANDED_COLUMNS)


@query("stream_landing")
def _(spark, sf_dir):
    layout = landed(spark, sf_dir)
    schema = tables.scan_raw(spark, layout.raw).schema
    stream = landing_stream(spark, layout.raw, schema)
    run_available(to_table(stream, layout.bronze, fresh_folder(spark, "progress")))
    return month_counts(tables.scan_bronze(spark, layout.bronze))


@query("schema_report")
def _(spark, sf_dir):
    return tables.schema_report(raw_trips(spark, sf_dir)).drop("position")


@query("row_count")
def _(spark, sf_dir):
    return raw_trips(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))


@query("write_bronze")
def _(spark, sf_dir):
    layout = landed(spark, sf_dir)
    sinks.write_bronze(stages.to_bronze(tables.scan_raw(spark, layout.raw)), layout.bronze)
    back = tables.scan_bronze(spark, layout.bronze)
    return back.select(
        *LANDED_COLUMNS,
        F.col("ingestion_time").isNotNull().alias("has_time"),
        F.col("source_file").endswith(".parquet").alias("has_file"),
    )


@query("write_silver")
def _(spark, sf_dir):
    layout = landed(spark, sf_dir)
    sinks.write_silver(silver_trips(spark, sf_dir), layout.silver, rebalance=True)
    return tables.scan_silver(spark, layout.silver).select(SILVER_COLUMNS)


@query("write_reject")
def _(spark, sf_dir):
    layout = landed(spark, sf_dir)
    sinks.write_reject(quality.rejected_rows(tagged_trips(spark, sf_dir)), layout.reject)
    return spark.read.parquet(layout.reject).select(*LANDED_COLUMNS, quality.STATUS, quality.REASON)


@query("write_gold_table")
def _(spark, sf_dir):
    path = landed(spark, sf_dir).gold_table(summaries.HOURLY.name)
    hourly = summaries.hourly_trip_summary(silver_trips(spark, sf_dir))
    sinks.write_gold_table(hourly, path, summaries.HOURLY.stored_by)
    return spark.read.parquet(path).drop("gold_processed_at")


@query("save_query_result")
def _(spark, sf_dir):
    layout, database = registered_lake(spark, sf_dir)
    sql = (
        "SELECT pickup_year, pickup_month, SUM(total_trips) AS total_trips "
        f"FROM `{database}`.daily_trip_summary GROUP BY pickup_year, pickup_month"
    )
    return sinks.save_query_result(spark, "monthly_trips", sql, f"{layout.gold}-results")


@query("register_raw")
def _(spark, sf_dir):
    layout, database = landed(spark, sf_dir), new_database(spark)
    catalog.create_database(spark, database, fresh_folder(spark, "database"))
    catalog.register_raw(spark, database, layout.raw)
    return month_counts(spark.table(f"`{database}`.raw"))


@query("register_silver")
def _(spark, sf_dir):
    layout, database = silver_lake(spark, sf_dir), new_database(spark)
    catalog.create_database(spark, database, fresh_folder(spark, "database"))
    catalog.register_silver(spark, database, layout.silver)
    by_month = spark.table(f"`{database}`.silver").groupBy("pickup_year", "pickup_month")
    return by_month.agg(F.count(F.lit(1)).alias("rows"))


@query("register_gold")
def _(spark, sf_dir):
    layout, database = gold_lake(spark, sf_dir), new_database(spark)
    catalog.create_database(spark, database, fresh_folder(spark, "database"))
    catalog.register_gold(spark, database, layout.gold)
    return analytics.gold_row_counts(analytics.registered_gold(spark, database))


@query("list_tables")
def _(spark, sf_dir):
    _, database = registered_lake(spark, sf_dir)
    return counts_by_table(spark, database, [row.table_name for row in catalog.list_tables(spark, database).collect()])


@query("create_database")
def _(spark, sf_dir):
    layout, database = landed(spark, sf_dir), new_database(spark)
    for _attempt in range(2):
        catalog.create_database(spark, database, fresh_folder(spark, "database"))
    catalog.register_raw(spark, database, layout.raw)
    return counts_by_table(spark, database, ["raw"])


# --- bronze ---------------------------------------------------------------------------------------------


@query("add_ingestion_time")
def _(spark, sf_dir):
    stamped = lineage.add_ingestion_time(raw_trips(spark, sf_dir))
    return stamped.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ingestion_time").alias("stamped"),
        (F.min("ingestion_time") == F.max("ingestion_time")).alias("same_time"),
    )


@query("add_source_file")
def _(spark, sf_dir):
    sourced = lineage.add_source_file(raw_trips(spark, sf_dir))
    folder = [
        F.regexp_extract("source_file", f"/{name}=([0-9]+)/", 1).cast("int").alias(name) for name in ("year", "month")
    ]
    return sourced.groupBy(*folder).agg(F.count(F.lit(1)).alias("rows"))


@query("bronze")
def _(spark, sf_dir):
    back = tables.scan_bronze(spark, bronze_lake(spark, sf_dir).bronze)
    folder = F.regexp_extract("source_file", "year=([0-9]+)/month=", 1).cast("int")
    return back.select(*LANDED_COLUMNS, folder.alias("source_year"))


# --- silver ---------------------------------------------------------------------------------------------


def _rejects_of(position: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reason = quality.trip_rules()[position].reason
        return quality.rejected_by(tagged_trips(spark, sf_dir), reason).select(*LANDED_COLUMNS, quality.REASON)

    return run


for _position in range(9):
    QUERIES[f"dq{_position + 1}"] = _rejects_of(_position)


@query("dq_reason")
def _(spark, sf_dir):
    return tagged_trips(spark, sf_dir).select(*LANDED_COLUMNS, quality.REASON)


@query("dq_status")
def _(spark, sf_dir):
    return tagged_trips(spark, sf_dir).groupBy("PULocationID", quality.STATUS).agg(F.count(F.lit(1)).alias("rows"))


@query("valid_rows")
def _(spark, sf_dir):
    return valid_trips(spark, sf_dir).select(*LANDED_COLUMNS, quality.STATUS)


@query("rejected_rows")
def _(spark, sf_dir):
    return quality.rejected_rows(tagged_trips(spark, sf_dir)).select(*LANDED_COLUMNS, quality.STATUS, quality.REASON)


@query("dq_metrics")
def _(spark, sf_dir):
    return quality.quality_metrics(tagged_trips(spark, sf_dir))


@query("rejects_by_reason")
def _(spark, sf_dir):
    return quality.rejects_by_reason(tagged_trips(spark, sf_dir))


@query("cast_types")
def _(spark, sf_dir):
    return shaping.cast_types(valid_trips(spark, sf_dir)).select(TRIP_COLUMNS)


def _added(step: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(valid_trips(spark, sf_dir)).select("VendorID", "PULocationID", shaping.PICKUP, *columns)

    return run


QUERIES["pickup_date"] = _added(shaping.add_pickup_date, "pickup_date")
QUERIES["pickup_year"] = _added(shaping.add_pickup_year, "pickup_year")
QUERIES["pickup_month"] = _added(shaping.add_pickup_month, "pickup_month")
QUERIES["pickup_hour"] = _added(shaping.add_pickup_hour, "pickup_hour")
QUERIES["pickup_dayofweek"] = _added(shaping.add_pickup_dayofweek, "pickup_dayofweek")
QUERIES["trip_duration_minutes"] = _added(shaping.add_trip_duration, shaping.DROPOFF, "trip_duration_minutes")
QUERIES["round_money"] = _added(shaping.round_money, *shaping.MONEY)


@query("silver_processed_at")
def _(spark, sf_dir):
    stamped = shaping.add_processed_time(valid_trips(spark, sf_dir))
    return stamped.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("silver_processed_at").alias("stamped"),
        (F.min("silver_processed_at") == F.max("silver_processed_at")).alias("same_time"),
    )


@query("drop_dq_columns")
def _(spark, sf_dir):
    return shaping.drop_quality_columns(valid_trips(spark, sf_dir))


@query("silver")
def _(spark, sf_dir):
    layout = silver_lake(spark, sf_dir)
    stored = tables.scan_silver(spark, layout.silver).select(SILVER_COLUMNS)
    return stored.withColumn("outcome", F.lit(quality.VALID)).unionByName(
        spark.read.parquet(layout.reject)
        .select(*LANDED_COLUMNS, F.col(quality.REASON).alias("outcome")),
        allowMissingColumns=True,
    )


# --- gold -----------------------------------------------------------------------------------------------


def _summary(summary: summaries.Summary) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return summaries.summarise(silver_trips(spark, sf_dir), summary).drop("gold_processed_at")

    return run


for _one in summaries.SUMMARIES:
    QUERIES[_one.name] = _summary(_one)


def _stored_gold(spark: SparkSession, layout: Layout) -> DataFrame:
    stored = [
        spark.read.parquet(layout.gold_table(one.name)).drop("gold_processed_at").withColumn("gold_table", F.lit(one.name))
        for one in summaries.SUMMARIES
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), stored)


@query("gold")
def _(spark, sf_dir):
    return _stored_gold(spark, gold_lake(spark, sf_dir))


@query("gold_refresh")
def _(spark, sf_dir):
    """Gold of all months but those of 2024, whose trips then come month by month into silver and into gold."""
    layout = bronze_lake(spark, sf_dir)
    silver = stages.to_silver(tables.scan_bronze(spark, layout.bronze))
    late = F.col("pickup_year") == 2024
    sinks.write_silver(silver.where(~late), layout.silver)
    stages.refresh_gold(spark, layout)
    sinks.write_silver(silver.where(late), layout.silver, dynamic=True)
    months = silver.where(late).select("pickup_year", "pickup_month").distinct().collect()
    stages.refresh_gold(spark, layout, [tuple(month) for month in months])
    return _stored_gold(spark, layout)


def _question(question: Callable[[analytics.Gold], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return question(stages.to_gold(silver_trips(spark, sf_dir)))

    return run


for _name, _function in analytics.QUESTIONS.items():
    QUERIES[_name] = _question(_function)


# --- landed files ---------------------------------------------------------------------------------------


@query("explode_arrivals")
def _(spark, sf_dir):
    return landed_files.explode_arrivals(adapters.arrivals(table(spark, sf_dir, "documents")))


@query("check_extension")
def _(spark, sf_dir):
    return landed_files.check_extension(file_rows(spark, sf_dir)).select("key", "extension_error")


@query("check_prefix")
def _(spark, sf_dir):
    return landed_files.check_prefix(file_rows(spark, sf_dir)).select("key", "prefix_error")


@query("check_size")
def _(spark, sf_dir):
    return landed_files.check_size(file_rows(spark, sf_dir)).select("key", "size", "size_error")


@query("check_columns")
def _(spark, sf_dir):
    return landed_files.check_columns(file_rows(spark, sf_dir)).select("key", "n_rows", "columns_error")


@query("validate_files")
def _(spark, sf_dir):
    findings = landed_files.validate_files(file_rows(spark, sf_dir))
    return findings.select(
        "bucket", "key", "is_valid",
        F.array_join("errors", "; ").alias("errors"),
        F.col("validated_at").isNotNull().alias("has_time"),
    )


@query("validated_scan")
def _(spark, sf_dir):
    """Landed months, of which December lacks a column and must not be read."""
    root = fresh_folder(spark, "landing")
    trips = raw_trips(spark, sf_dir)
    land(trips.where(F.col("month") != 12), root)
    land(trips.where(F.col("month") == 12).drop("VendorID"), root, mode="append")
    findings = landed_files.validate_files(manifest.file_manifest(spark, root, "raw-bucket"))
    return month_counts(manifest.validated_scan(spark, findings, root))


def _arrival_events(spark: SparkSession, root: str) -> DataFrame:
    """Two events for every file under ``root``, the second up to a day later, and one for a name without a file."""
    files = manifest.list_files(spark, root)
    base = stores.split_path(root)[2].rstrip("/") + "/"
    key = F.substr("path", F.locate(base, F.col("path")) + F.lit(len(base)))
    turn = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    named = files.select(key.alias("key"), "size", turn.alias("turn"))
    second = F.pmod(F.xxhash64("key"), F.lit(86_400))
    at = F.timestamp_add("SECOND", F.when(F.col("turn") == 1, second).otherwise(0), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    name = F.when(F.col("turn") == 2, F.concat("key", F.lit(".gone.parquet"))).otherwise(F.col("key"))
    record = F.struct(
        F.struct(
            F.struct(F.lit("raw-bucket").alias("name")).alias("bucket"),
            F.struct(F.url_encode(name).alias("key"), "size").alias("object"),
        ).alias("s3")
    )
    return named.select(at.alias("ts"), F.to_json(F.struct(F.array(record).alias("Records"))).alias("body"))


def _picked_up(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Bronze and findings of a stream of arrival events over landed months, of which December lacks a column."""
    root = fresh_folder(spark, "landing")
    trips = raw_trips(spark, sf_dir)
    land(trips.where(F.col("month") != 12), root)
    land(trips.where(F.col("month") == 12).drop("VendorID"), root, mode="append")
    trips.limit(10).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(f"{root}/{LANDING_PREFIX}year=2024/month=notes")
    inbox, bronze, findings, taken, progress = (fresh_folder(spark, name) for name in ("inbox", "bronze", "findings", "ledger", "progress"))
    events = _arrival_events(spark, root)
    # The first half of the day arrives, then the rest, with repeats of files already taken.
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp")
    for part in (events.where(F.col("ts") < noon), events.where(F.col("ts") >= noon)):
        part.coalesce(2).write.mode("append").parquet(inbox)
        stream = landing_stream(spark, inbox, events.schema)
        run_available(stream_arrivals(stream, root, bronze, findings, taken, progress))
    return bronze, findings


@query("stream_arrivals")
def _(spark, sf_dir):
    bronze, _ = _picked_up(spark, sf_dir)
    return month_counts(arrived(spark, bronze))


@query("arrival_findings")
def _(spark, sf_dir):
    """How many files each finding was made on; names and sizes of files differ from run to run."""
    _, findings = _picked_up(spark, sf_dir)
    found = arrival_findings(spark, findings)
    kind = F.when(F.col("is_valid"), "valid").when(F.col("key").endswith(".gone.parquet"), "gone").when(
        F.exists("errors", lambda error: error.contains("'VendorID'")), "VendorID"
    ).otherwise("other")
    valid_once = found.where("is_valid").agg(F.count(F.lit(1)) == F.countDistinct("key")).first()[0]
    return found.select(kind.alias("finding")).distinct().withColumn("each_file_once", F.lit(bool(valid_once)))


# --- run records, routing, notices ----------------------------------------------------------------------


@query("parse_run_event")
def _(spark, sf_dir):
    return audit.parse_run_event(run_events(spark, sf_dir)).select("event_id", *AUDIT_COLUMNS)


@query("audit_upsert")
def _(spark, sf_dir):
    """Two batches merged into the stored table, of which the first comes again at the end."""
    path = fresh_folder(spark, "audit")
    parsed = audit.parse_run_event(run_events(spark, sf_dir)).withColumnRenamed("event_id", "sequence")
    later = F.col("sequence") % 3 == 0
    for number, rows in ((0, parsed.where(later)), (1, parsed.where(~later)), (0, parsed.where(later))):
        # A record logged again later wins; these are logged at once, and the sequence tells them apart.
        stamped = rows.withColumn("logged_at", F.lit("2024-01-01T00:00:00Z"))
        control.keyed_audit(path).merge(stamped, "events", number)
    return control.keyed_audit(path).read(spark).select(AUDIT_COLUMNS)


@query("audit_lookup")
def _(spark, sf_dir):
    """The record of the first run and event time, from its bucket alone."""
    path = fresh_folder(spark, "audit")
    parsed = audit.parse_run_event(run_events(spark, sf_dir)).withColumnRenamed("event_id", "sequence")
    control.upsert_audit(parsed, path, "events", 0)
    key = parsed.select(F.min(F.struct(*audit.AUDIT_KEY)).alias("key")).first()["key"]
    return control.keyed_audit(path).lookup(spark, **key.asDict()).select(AUDIT_COLUMNS)


@query("audit_retention")
def _(spark, sf_dir):
    logged = audit.parse_run_event(run_events(spark, sf_dir)).withColumn(
        "logged_at", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )
    kept = audit.within_retention(logged, dt.datetime(2024, 4, 15))
    return kept.select("event_id", *AUDIT_COLUMNS, "logged_at")


@query("audit_status_counts")
def _(spark, sf_dir):
    parsed = audit.parse_run_event(run_events(spark, sf_dir))
    return audit.status_counts(audit.latest_records(parsed, "event_id"))


def _routed(route: Callable[[DataFrame], DataFrame], *extra: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return route(routing.open_events(run_events(spark, sf_dir))).select(
            "event_id",
            F.col("event.detail.jobName").alias("job_name"),
            F.col("event.detail.state").alias("state"),
            *extra,
        )

    return run


QUERIES["route_success"] = _routed(routing.route_success)
QUERIES["route_failure"] = _routed(routing.route_failure)
QUERIES["route_complete"] = _routed(routing.route_complete)
QUERIES["route_events"] = _routed(routing.route_events, "rule")


@query("route_patterns")
def _(spark, sf_dir):
    """The stage rules and a thousand others, as documents: one per run for its failures or late messages."""
    runs = {
        f"run-{number}": {"detail": {"jobRunId": [str(number)], "state": list(FAILURE_STATES), "message": [{"prefix": "event 1"}, None]}}
        for number in range(1000)
    }
    odd = {"other-states": {"detail": {"state": [{"anything-but": ["SUCCEEDED", *FAILURE_STATES]}], "message": [{"exists": True}]}}}
    routed = patterns.route_by_patterns(run_events(spark, sf_dir), {**patterns.STAGE_PATTERNS, **runs, **odd})
    return routed.select("event_id", "rule")


@query("parse_notification")
def _(spark, sf_dir):
    return notices.parse_notification(run_events(spark, sf_dir)).select("event_id", *notices.NOTICE_FIELDS)


@query("render_notification")
def _(spark, sf_dir):
    rendered = notices.render_notification(notices.parse_notification(run_events(spark, sf_dir)))
    return rendered.select("event_id", "subject", "text_body", "html_body")


@query("notification_log")
def _(spark, sf_dir):
    entries = notices.notification_log(notices.parse_notification(run_events(spark, sf_dir)))
    return entries.select(
        "message",
        F.col("stream").rlike("^[0-9]{4}/[0-9]{2}/[0-9]{2}$").alias("by_day"),
        (F.col("timestamp") > 0).alias("has_time"),
    )


@query("notification_outbox")
def _(spark, sf_dir):
    rendered = notices.render_notification(notices.parse_notification(run_events(spark, sf_dir)))
    outbox = notices.notification_outbox(rendered, "sender@example.com", "recipient@example.com")
    return outbox.select("job_name", "state", "job_run_id", "event_time", "subject", "sender", "recipient", "deliver")


# --- alarms ---------------------------------------------------------------------------------------------


def _alarm(rule: alarms.AlarmRule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return alarms.evaluate_alarms(metric_rows(spark, sf_dir), [rule])

    return run


QUERIES["alarm_task_failures"] = _alarm(alarms.TASK_FAILURES)
QUERIES["alarm_function_errors"] = _alarm(alarms.FUNCTION_ERRORS)
QUERIES["alarm_audit_errors"] = _alarm(alarms.AUDIT_ERRORS)
QUERIES["alarm_run_failures"] = _alarm(alarms.RUN_FAILURES)


def _no_zone(fired: DataFrame) -> DataFrame:
    return fired.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


@query("alarm_engine")
def _(spark, sf_dir):
    """All rules over the events as a stream: every alarm that the rows seen so far fire."""
    path, progress = fresh_folder(spark, "sums"), fresh_folder(spark, "progress")
    for writer in stream_window_sums(adapters.metrics(table_stream(spark, sf_dir, "events")), path, progress):
        run_available(writer)
    return _no_zone(fired_alarms(spark, path))


def _alarms_of_closed_windows(spark: SparkSession, sf_dir: str, rules) -> DataFrame:
    path = fresh_folder(spark, "alarms")
    stream = adapters.metrics(table_stream(spark, sf_dir, "events"))
    for writer in stream_alarms(stream, path, fresh_folder(spark, "progress"), rules):
        run_available(writer)
    return _no_zone(closed_alarms(spark, path))


@query("alarm_closed_windows")
def _(spark, sf_dir):
    """All rules over the events as a stream: alarms in windows the watermark has closed."""
    return _alarms_of_closed_windows(spark, sf_dir, alarms.ALARM_RULES)


# The alarm families with longer periods, of which up to three must breach in a row.
LONG_RULES = (
    replace(alarms.TASK_FAILURES, period_seconds=3600, threshold=2.0),
    replace(alarms.FUNCTION_ERRORS, period_seconds=10800, evaluation_periods=2),
    replace(alarms.AUDIT_ERRORS, period_seconds=10800, evaluation_periods=3),
    replace(alarms.RUN_FAILURES, period_seconds=10800, evaluation_periods=2, threshold=2.0),
)


@query("alarm_periods")
def _(spark, sf_dir):
    """Rules over one, two and three periods as a stream: alarms in windows the watermark has closed."""
    return _alarms_of_closed_windows(spark, sf_dir, LONG_RULES)


@query("alarm_periods_now")
def _(spark, sf_dir):
    """The same rules over the sums known so far."""
    path, progress = fresh_folder(spark, "sums"), fresh_folder(spark, "progress")
    for writer in stream_window_sums(adapters.metrics(table_stream(spark, sf_dir, "events")), path, progress, LONG_RULES):
        run_available(writer)
    return _no_zone(fired_alarms(spark, path, LONG_RULES))


# --- streams --------------------------------------------------------------------------------------------


@query("stream_dq_split")
def _(spark, sf_dir):
    layout = landed(spark, sf_dir)
    trips = landing_stream(spark, layout.raw, raw_trips(spark, sf_dir).schema)
    run_available(quality_split(trips, layout.silver, layout.reject, fresh_folder(spark, "progress")))
    valid = tables.scan_silver(spark, layout.silver).select("PULocationID", F.lit(quality.VALID).alias("outcome"))
    rejects = spark.read.parquet(layout.reject).select("PULocationID", F.col(quality.REASON).alias("outcome"))
    return valid.unionAll(rejects).groupBy("PULocationID", "outcome").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_audit")
def _(spark, sf_dir):
    path = fresh_folder(spark, "audit")
    events = adapters.run_events(table_stream(spark, sf_dir, "events")).withColumnRenamed("event_id", "sequence")
    run_available(start_audit(events, path, fresh_folder(spark, "progress"), "events"))
    return control.audit_table(spark, path).select(AUDIT_COLUMNS)


@query("stream_audit_table")
def _(spark, sf_dir):
    path = fresh_folder(spark, "audit")
    events = adapters.run_events(table_stream(spark, sf_dir, "events")).withColumnRenamed("event_id", "sequence")
    run_available(start_audit_table(events, path, fresh_folder(spark, "progress")))
    return control.keyed_audit(path).read(spark).select(AUDIT_COLUMNS)


# --- runs -----------------------------------------------------------------------------------------------


def _outcome(spark: SparkSession, run: stages.Run, layers: dict[str, str]) -> DataFrame:
    """What was recorded and sent, beside how many rows each finished layer holds."""
    recorded = control.audit_table(spark, run.layout.audit)
    mailed = spark.read.parquet(run.layout.outbox)
    fields = ["job_name", "job_run_id", "state", "message"]
    said = recorded.select(F.lit("audit").alias("channel"), *fields).unionAll(mailed.select(F.lit("notice").alias("channel"), *fields))
    held = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).cast("string").alias("message"))
        .select(F.lit(name).alias("channel"), F.lit("rows").alias("job_name"), F.lit(run.name).alias("job_run_id"), F.lit("HELD").alias("state"), "message")
        for name, path in layers.items()
    ]
    return reduce(DataFrame.unionAll, [said, *held])


@query("run_stages")
def _(spark, sf_dir):
    layout = landed(spark, sf_dir)
    stages.run_stages(spark, stages.Run(layout))
    return analytics.gold_row_counts(
        {one.name: spark.read.parquet(layout.gold_table(one.name)) for one in summaries.SUMMARIES}
    )


@query("on_success")
def _(spark, sf_dir):
    run = stages.Run(landed(spark, sf_dir), name="run-1")
    stages.run_stages(spark, run)
    return _outcome(spark, run, {"bronze": run.layout.bronze, "silver": run.layout.silver, "reject": run.layout.reject})


@query("on_failure")
def _(spark, sf_dir):
    """A run whose silver cannot be written, since a file stands where its folder should: bronze passes."""
    layout = landed(spark, sf_dir)
    spark.range(1).coalesce(1).write.parquet(f"{layout.silver}-blocker")
    blocker = spark.read.format("binaryFile").load(f"{layout.silver}-blocker").first().path
    run = stages.Run(Layout(**{**vars(layout), "silver": f"{blocker}/silver"}), name="run-1")
    try:
        stages.run_stages(spark, run)
    except stages.RunFailed:
        return _outcome(spark, run, {"bronze": run.layout.bronze})
    raise AssertionError("the run should have failed")


@query("post_run_register")
def _(spark, sf_dir):
    _, database = registered_lake(spark, sf_dir)
    names = sorted(row.table_name for row in catalog.list_tables(spark, database).collect())
    return counts_by_table(spark, database, names)
