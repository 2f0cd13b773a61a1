from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from meterline.checks import queries
from meterline.operators import notices, routing
from meterline.operators.alarms import ALARM_RULES, AlarmRule, evaluate_alarms
from meterline.operators.quality import REASON, quality_metrics
from meterline.plans import stages
from meterline.sources import adapters, control
from meterline.streaming.alarms import closed_alarms, fired_alarms, stream_alarms, stream_window_sums
from meterline.streaming.audit import stream_audit
from meterline.streaming.landing import run_available, stream_landing, to_table
from meterline.streaming.quality_split import counted, quality_split, watch_counts

METRICS = "ts timestamp, namespace string, metric string, dimension string, value double"


def _split_in_time(df, path, parts):
    """Writes ``df`` as ``parts`` files, in the order of time."""
    bounds = [row.ts for row in df.select("ts").orderBy("ts").collect()]
    edges = [bounds[len(bounds) * part // parts] for part in range(1, parts)]
    lower = None
    for part in range(parts):
        upper = edges[part] if part < len(edges) else None
        rows = df
        if lower is not None:
            rows = rows.where(F.col("ts") >= lower)
        if upper is not None:
            rows = rows.where(F.col("ts") < upper)
        rows.coalesce(1).write.mode("append").parquet(path)
        lower = upper


def test_alarms_of_a_stream_in_parts_are_those_of_the_batch(spark, sf_dir, tmp_path):
    """New files arrive between runs of the query, which goes on from its checkpoint."""
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    metrics = adapters.metrics(queries.table(spark, sf_dir, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    cut = metrics.agg(F.percentile_approx(F.col("ts").cast("double"), 0.5)).first()[0]
    early = F.col("ts").cast("double") < cut
    for part in (metrics.where(early), metrics.where(~early)):
        _split_in_time(part, source, 2)
        stream = stream_landing(spark, source, metrics.schema)
        for writer in stream_alarms(stream, out, progress):
            run_available(writer)
    found = {tuple(row) for row in closed_alarms(spark, out).select("alarm", "window_start", "total").collect()}
    closed = metrics.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    expected = evaluate_alarms(metrics).where(F.col("window_end") <= F.lit(closed)).select("alarm", "window_start", "total")
    assert found == {tuple(row) for row in expected.collect()} != set()


def test_rules_that_share_a_period_share_an_aggregation(spark, sf_dir):
    fired = evaluate_alarms(adapters.metrics(queries.table(spark, sf_dir, "events")))
    plan = fired._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate ") == len({rule.period_seconds for rule in ALARM_RULES})


def test_alarm_that_needs_several_periods(spark):
    rule = AlarmRule("slow", "n", "m", ("d",), 60, threshold=2.0, evaluation_periods=3)
    minutes = {0: 2.0, 1: 1.0, 2: 3.0, 3: 3.0, 4: 2.0, 5: 2.0, 7: 9.0, 8: 9.0}
    rows = [(dt.datetime(2024, 1, 1, 0, minute, 5), "n", "m", "d", value) for minute, value in minutes.items()]
    fired = evaluate_alarms(spark.createDataFrame(rows, METRICS), [rule]).collect()
    assert sorted((row.window_start.minute, row.total) for row in fired) == [(4, 2.0), (5, 2.0)]
    assert all(row.alarm == "d-slow" and row.window_end - row.window_start == dt.timedelta(minutes=1) for row in fired)


def test_alarm_sums_values_and_ignores_other_metrics(spark):
    rule = AlarmRule("x", "n", "m", ("d",), 60, threshold=2.0)
    at = dt.datetime(2024, 1, 1)
    rows = [(at, "n", "m", "d", 1.5), (at, "n", "m", "d", 0.5), (at, "n", "m", "other", 9.0), (at, "other", "m", "d", 9.0)]
    fired = evaluate_alarms(spark.createDataFrame(rows, METRICS), [rule]).collect()
    assert [(row.alarm, row.total) for row in fired] == [("d-x", 2.0)]


SLOW_RULES = [
    AlarmRule("one", "n", "m", ("d",), 60, threshold=2.0),
    AlarmRule("two", "n", "m", ("d",), 60, threshold=2.0, evaluation_periods=2),
    AlarmRule("three", "n", "m", ("d",), 60, threshold=2.0, evaluation_periods=3),
]
MINUTES = {0: 2.0, 1: 1.0, 2: 3.0, 3: 3.0, 4: 2.0, 5: 2.0, 7: 9.0, 8: 9.0, 40: 0.0}


def _minute_rows(spark, minutes):
    rows = [(dt.datetime(2024, 1, 1, 0, minute, 5), "n", "m", "d", value) for minute, value in minutes.items()]
    return spark.createDataFrame(rows, METRICS).coalesce(1)


def _named(frame):
    return sorted((row.alarm, row.window_start.minute, row.total) for row in frame.collect())


def test_a_stream_evaluates_rules_over_several_periods_as_the_batch_does(spark, tmp_path):
    """Runs of breaching windows reach over micro-batches and over a restart."""
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    for low, high in ((0, 3), (3, 5), (5, 60)):
        _minute_rows(spark, {minute: value for minute, value in MINUTES.items() if low <= minute < high}).write.mode("append").parquet(source)
        for writer in stream_alarms(stream_landing(spark, source, METRICS), out, progress, SLOW_RULES, "1 minute"):
            run_available(writer)
    found = _named(closed_alarms(spark, out))
    assert found == _named(evaluate_alarms(_minute_rows(spark, MINUTES), SLOW_RULES))
    assert [one[:2] for one in found if one[0] != "d-one"] == [("d-three", 4), ("d-three", 5), ("d-two", 3), ("d-two", 4), ("d-two", 5), ("d-two", 8)]


def test_alarms_are_there_with_the_batch_that_reaches_the_threshold(spark, tmp_path):
    """No later row has to come; a row that comes late corrects its window."""
    source, sums, progress = (str(tmp_path / name) for name in ("in", "sums", "progress"))
    seen = {}
    for part in ({0: 2.0, 1: 1.0}, {2: 3.0, 3: 3.0}, {1: 1.0, 4: 2.0}):
        _minute_rows(spark, part).write.mode("append").parquet(source)
        for minute, value in part.items():
            seen[minute] = seen.get(minute, 0.0) + value
        for writer in stream_window_sums(stream_landing(spark, source, METRICS), sums, progress, SLOW_RULES):
            run_available(writer)
        assert _named(fired_alarms(spark, sums, SLOW_RULES)) == _named(evaluate_alarms(_minute_rows(spark, seen), SLOW_RULES))


def test_audit_stream_goes_on_after_a_restart_without_doubles(spark, sf_dir, tmp_path):
    source, log, progress = (str(tmp_path / name) for name in ("in", "log", "progress"))
    events = adapters.run_events(queries.table(spark, sf_dir, "events")).withColumnRenamed("event_id", "sequence")
    half = events.agg(F.max("sequence")).first()[0] // 2
    for part in (F.col("sequence") <= half, F.col("sequence") > half):
        events.where(part).write.mode("append").parquet(source)
        run_available(stream_audit(stream_landing(spark, source, events.schema), log, progress, "events"))
    assert control.audit_log(spark, log).count() == events.count()
    expected = queries.QUERIES["audit_upsert"](spark, sf_dir)
    found = control.audit_table(spark, log).select(expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_audit_streams_of_one_name_do_not_overwrite_each_other(spark, sf_dir, tmp_path):
    log = str(tmp_path / "log")
    events = adapters.run_events(queries.table(spark, sf_dir, "events")).withColumnRenamed("event_id", "sequence")
    for number in (1, 2):
        source = str(tmp_path / f"in-{number}")
        events.where(F.col("sequence") == number).write.parquet(source)
        run_available(stream_audit(stream_landing(spark, source, events.schema), log, str(tmp_path / f"p-{number}"), "events"))
    assert control.audit_log(spark, log).count() == 2


def test_split_stream_gives_the_batch_tables(spark, sf_dir, tmp_path):
    source, silver, reject, progress = (str(tmp_path / name) for name in ("in", "silver", "reject", "progress"))
    raw = queries.raw_trips(spark, sf_dir)
    raw.repartition(3).write.parquet(source)
    stream = stream_landing(spark, source, raw.schema, files_per_trigger=1)
    counts = watch_counts(spark, "split-of-the-test")
    query = run_available(quality_split(stream, silver, reject, progress).queryName("split-of-the-test"))
    batches = [step for step in query.recentProgress if step.numInputRows]
    assert len(batches) == 3 and sum(step.numInputRows for step in batches) == raw.count()  # each row is read once
    reasons = stages.to_rejects(raw).select(REASON).distinct().count()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(reject).count()
    assert files <= 3 * reasons
    assert spark.read.parquet(silver).count() == stages.to_silver(raw).count()
    by_reason = lambda df: {row[REASON]: row["count"] for row in df.groupBy(REASON).count().collect()}
    assert by_reason(spark.read.parquet(reject)) == by_reason(stages.to_rejects(raw))
    for _ in range(100):  # reports come after the batch
        if len(counts.reports) == 3:
            break
        time.sleep(0.1)
    spark.streams.removeListener(counts)
    said, metrics = counts.total(), quality_metrics(queries.tagged_trips(spark, sf_dir)).first()
    assert len(counts.reports) == 3 and said.rejected == by_reason(stages.to_rejects(raw))
    assert (said.total, said.valid, round(said.rejection_rate, 2)) == (metrics.total_rows, metrics.valid_rows, metrics.rejection_rate_pct)


def test_routing_and_notices_work_on_a_stream(spark, sf_dir, tmp_path):
    events = adapters.run_events(queries.table(spark, sf_dir, "events"))
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = stream_landing(spark, str(tmp_path / "in"), events.schema)
    routed = routing.route_events(routing.open_events(stream)).select("event_id", "rule")
    run_available(to_table(routed, str(tmp_path / "routed"), str(tmp_path / "p1")))
    expected = routing.route_events(routing.open_events(events)).groupBy("rule").count()
    assert sorted(spark.read.parquet(str(tmp_path / "routed")).groupBy("rule").count().collect()) == sorted(expected.collect())
    outbox = notices.notification_outbox(notices.render_notification(notices.parse_notification(stream)), "a@x", "b@x")
    run_available(to_table(outbox, str(tmp_path / "outbox"), str(tmp_path / "p2")))
    assert spark.read.parquet(str(tmp_path / "outbox")).where("deliver").count() == events.count()


def test_counts_go_through_the_rules_once_a_row(spark, sf_dir):
    """The observed expressions compare a column; the chain of rules stands below them, once."""
    trips = queries.raw_trips(spark, sf_dir).limit(50).withColumn("counted_reason", F.lit("mine"))
    found = counted(trips)
    assert found.columns == trips.columns and {row.counted_reason for row in found.collect()} == {"mine"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    observed = next(line for line in plan.splitlines() if "CollectMetrics" in line)
    assert "CASE WHEN" not in observed and plan.count("CASE WHEN") == 1
