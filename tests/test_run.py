from __future__ import annotations

import json

import pytest

from meterline.checks import queries
from meterline.plans import stages
from meterline.sources import control


def _fails(spark, layout):
    raise RuntimeError("broken stage")


def _passes(spark, layout):
    return None


@pytest.fixture
def run(tmp_path):
    return stages.Run(stages.Layout.under(str(tmp_path)), name="run-7", sender="a@x", recipient="b@x")


def _audit(spark, run):
    return [(row.job_run_id, row.state, row.message) for row in control.audit_table(spark, run.layout.audit).collect()]


def _outbox(spark, run):
    return [(row.job_run_id, row.state, row.deliver) for row in spark.read.parquet(run.layout.outbox).collect()]


def _missing(path_reader):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        path_reader()


def test_success_is_audited_under_the_start_time_and_announced(spark, run):
    stages.run_stages(spark, run, [_passes])
    row = control.audit_table(spark, run.layout.audit).first()
    assert (row.job_run_id, row.event_time, row.started_on) == ("run-7", run.started_at, run.started_at)
    assert row.state == "SUCCEEDED" and row.completed_on >= row.started_on
    assert _outbox(spark, run) == [("run-7", "SUCCEEDED", True)]
    logged = spark.read.parquet(run.layout.notices).first()
    assert json.loads(logged.message)["job_run_id"] == "run-7"
    assert len(logged.stream.split("/")) == 3


def test_stages_after_a_failure_do_not_run(spark, run):
    later = []
    with pytest.raises(stages.RunFailed) as failure:
        stages.run_stages(spark, run, [_passes, _fails, lambda *_: later.append(1)])
    assert str(failure.value.__cause__) == "broken stage"
    assert later == []
    assert _audit(spark, run) == [("run-7", "FAILED", "Pipeline failed")]
    assert _outbox(spark, run) == [("run-7", "FAILED", True)]


def test_without_a_failure_notice_there_is_no_audit_record(spark, run, monkeypatch):
    def send_notice(*_):
        raise OSError("no mail")

    monkeypatch.setattr(stages, "send_notice", send_notice)
    with pytest.raises(stages.RunFailed):
        stages.run_stages(spark, run, [_fails])
    _missing(lambda: _audit(spark, run))


def test_a_failing_audit_does_not_fail_a_run_and_the_notice_still_goes_out(spark, run, monkeypatch):
    def record_audit(*_):
        raise OSError("no table")

    monkeypatch.setattr(stages, "record_audit", record_audit)
    stages.run_stages(spark, run, [_passes])
    assert _outbox(spark, run) == [("run-7", "SUCCEEDED", True)]
    _missing(lambda: _audit(spark, run))


def test_a_failing_notice_does_not_fail_a_successful_run(spark, run, monkeypatch):
    def send_notice(*_):
        raise OSError("no mail")

    monkeypatch.setattr(stages, "send_notice", send_notice)
    stages.run_stages(spark, run, [_passes])
    assert _audit(spark, run) == [("run-7", "SUCCEEDED", "All pipeline stages completed successfully")]


def test_registration_follows_a_run(spark, sf_dir):
    layout = queries.gold_lake(spark, sf_dir)
    database = queries.new_database(spark)
    listed = stages.register_tables(spark, layout, database)
    assert sorted(row.table_name for row in listed.collect()) == [
        "daily_trip_summary", "hourly_trip_summary", "location_trip_summary", "payment_type_summary", "silver",
    ]
