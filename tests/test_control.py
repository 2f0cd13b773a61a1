from __future__ import annotations

import datetime as dt
import json

import pytest

from meterline.operators import audit, notices, routing
from meterline.sources import control


def _events(spark, *events):
    return spark.createDataFrame([(number, json.dumps(event)) for number, event in enumerate(events)], "sequence bigint, body string")


def _stage_event(state, job="gold-job", **detail):
    return {
        "source": "aws.glue",
        "detail-type": "Glue Job State Change",
        "time": "2024-01-01T00:00:00Z",
        "detail": {"jobName": job, "state": state, "jobRunId": "r1", **detail},
    }


def test_missing_fields_get_defaults(spark):
    row = audit.parse_run_event(_events(spark, {})).first()
    assert (row.job_name, row.state, row.job_run_id) == ("unknown",) * 3
    assert (row.message, row.started_on, row.completed_on) == ("",) * 3
    moment = dt.datetime.fromisoformat(row.event_time)
    assert moment.utcoffset() == dt.timedelta(0)
    assert abs(dt.datetime.now(dt.timezone.utc) - moment) < dt.timedelta(minutes=5)


def test_now_is_utc_in_any_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        moment = dt.datetime.fromisoformat(audit.parse_run_event(_events(spark, {})).first().event_time)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(dt.datetime.now(dt.timezone.utc) - moment) < dt.timedelta(minutes=5)


def test_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "audit")
    events = _events(spark, _stage_event("RUNNING"), _stage_event("FAILED"), _stage_event("STOPPED", jobRunId="r2"))
    control.append_audit(audit.parse_run_event(events), path)
    states = {row.job_run_id: row.state for row in control.audit_table(spark, path).collect()}
    assert states == {"r1": "FAILED", "r2": "STOPPED"}
    control.append_audit(audit.parse_run_event(_events(spark, _stage_event("SUCCEEDED"))), path)
    states = {row.job_run_id: row.state for row in control.audit_table(spark, path).collect()}
    assert states == {"r1": "SUCCEEDED", "r2": "STOPPED"}


def test_writing_a_batch_again_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "audit")
    parsed = audit.parse_run_event(_events(spark, _stage_event("FAILED")))
    for _ in range(2):
        control.append_audit(parsed, path, batch="b-1")
    assert control.audit_log(spark, path).count() == 1


def test_retention_boundary(spark):
    logged = ["2024-01-01T00:00:00.000000+00:00", "2023-12-31T23:59:59.999999+00:00"]
    records = spark.createDataFrame([(value,) for value in logged], "logged_at string")
    kept = audit.within_retention(records, dt.datetime(2024, 1, 1) + dt.timedelta(days=90))
    assert [row.logged_at for row in kept.collect()] == logged[:1]


def test_retention_reads_only_the_days_it_keeps_and_compaction_drops_the_others(spark, tmp_path):
    path, target = str(tmp_path / "audit"), str(tmp_path / "compacted")
    parsed = audit.parse_run_event(_events(spark, _stage_event("RUNNING"), _stage_event("FAILED"), _stage_event("STOPPED", jobRunId="r2")))
    control.append_audit(parsed, path)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    kept = audit.within_retention(control.audit_log(spark, path), now)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "logged_day" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert kept.count() == 3
    before = sorted(map(str, control.audit_table(spark, path).collect()))
    control.compact_audit(spark, path, target, now)
    assert sorted(map(str, control.audit_table(spark, target).collect())) == before
    assert control.audit_log(spark, target).count() == 2
    control.compact_audit(spark, path, str(tmp_path / "later"), now + dt.timedelta(days=200))
    assert control.audit_log(spark, str(tmp_path / "later")).count() == 0


@pytest.mark.parametrize("route", [routing.route_success, routing.route_failure, routing.route_complete, routing.route_events])
def test_events_are_parsed_once(spark, sf_dir, route):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("to_json(struct(*)) AS body")
    plan = route(routing.open_events(events)).select("event.detail.state")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 1


@pytest.mark.parametrize(
    ("event", "rules"),
    [
        (_stage_event("SUCCEEDED"), {"success", "complete"}),
        (_stage_event("SUCCEEDED", job="silver-job"), {"success"}),
        (_stage_event("FAILED"), {"failure"}),
        (_stage_event("ERROR"), {"failure"}),
        (_stage_event("STOPPED"), {"failure"}),
        (_stage_event("RUNNING"), set()),
        ({**_stage_event("SUCCEEDED"), "source": "other"}, set()),
        ({**_stage_event("FAILED"), "detail-type": "other"}, set()),
        ({}, set()),
    ],
)
def test_routing(spark, event, rules):
    routed = routing.route_events(routing.open_events(_events(spark, event)))
    assert {row.rule for row in routed.collect()} == rules


def test_notice_of_a_success(spark):
    event = _stage_event("SUCCEEDED", message="done")
    row = notices.render_notification(notices.parse_notification(_events(spark, event)), title="Trips").first()
    assert row.subject == "✅ Trips — SUCCEEDED"
    assert row.text_body.splitlines()[2:] == [
        "Pipeline  : Trips", "Status    : SUCCEEDED", "Job Name  : gold-job", "Exec ID   : r1",
        "Time      : 2024-01-01T00:00:00Z", "Message   : done",
    ]
    assert "#2e7d32" in row.html_body and "#e8f5e9" in row.html_body and "{" not in row.html_body


@pytest.mark.parametrize("state", ["FAILED", "RUNNING"])
def test_any_other_state_reads_as_a_failure(spark, state):
    row = notices.render_notification(notices.parse_notification(_events(spark, _stage_event(state, message="")))).first()
    assert row.subject.startswith("❌") and "#c62828" in row.html_body
    assert "No additional details" in row.text_body and "No additional details" in row.html_body


def test_outbox_delivers_only_with_both_addresses(spark):
    rendered = notices.render_notification(notices.parse_notification(_events(spark, _stage_event("FAILED"))))
    for sender, recipient, deliver in [("a@x", "b@x", True), ("a@x", None, False), (None, "b@x", False), ("", "b@x", False)]:
        assert notices.notification_outbox(rendered, sender, recipient).first().deliver is deliver


def test_notice_log_is_json_by_day(spark):
    entry = notices.notification_log(notices.parse_notification(_events(spark, _stage_event("FAILED")))).first()
    assert json.loads(entry.message)["job_run_id"] == "r1"
    assert entry.stream == dt.datetime.now(dt.timezone.utc).strftime("%Y/%m/%d")
