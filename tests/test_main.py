from __future__ import annotations

from meterline.__main__ import main
from meterline.checks import queries
from meterline.plans import analytics
from meterline.sources import control


def test_a_run_from_the_command_line(spark, sf_dir, tmp_path, capsys):
    landing = queries.landed(spark, sf_dir).raw
    paths = ["--base", str(tmp_path), "--raw", landing]
    main(["run", *paths, "--run-name", "run-9"], spark)
    assert [row.state for row in control.audit_table(spark, f"{tmp_path}/control/audit").collect()] == ["SUCCEEDED"]
    main(["questions", *paths, "--results", str(tmp_path / "answers")], spark)
    assert "Morning Rush (7-9am)" in capsys.readouterr().out
    assert {path.name for path in (tmp_path / "answers").iterdir()} == set(analytics.QUESTIONS)


def test_stages_one_by_one(spark, sf_dir, tmp_path):
    paths = ["--base", str(tmp_path), "--raw", queries.landed(spark, sf_dir).raw]
    for job in ("bronze", "silver", "gold"):
        main([job, *paths], spark)
    main(["register", *paths, "--database", "from_main"], spark)
    assert spark.table("from_main.daily_trip_summary").count() > 0


def test_options_reach_the_stages(spark, sf_dir, tmp_path):
    paths = ["--base", str(tmp_path), "--raw", queries.landed(spark, sf_dir).raw]
    main(["run", *paths, "--validate", "bucket", "--rebalance", "--dynamic", "--replace-rejects", "--database", "from_run"], spark)
    assert [row.state for row in control.audit_table(spark, f"{tmp_path}/control/audit").collect()] == ["SUCCEEDED"]
    assert spark.table("from_run.silver").count() > 0 and spark.table("from_run.payment_type_summary").count() > 0
