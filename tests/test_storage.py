from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from meterline.checks import queries
from meterline.config import Layout
from meterline.operators import lineage, quality, summaries
from meterline.plans import analytics, stages
from meterline.sources import catalog, sinks, tables, workspace
from rows import trips


def test_source_file_equals_input_file_name(spark, sf_dir):
    raw = queries.raw_trips(spark, sf_dir)
    both = lineage.add_source_file(raw).withColumn("expected", F.input_file_name())
    assert both.where(~F.col("source_file").eqNullSafe(F.col("expected"))).count() == 0


def test_overwrite_replaces_partitions_of_earlier_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    months = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, pickup_year int, pickup_month int")
    sinks.write_silver(months, path)
    sinks.write_silver(months.where("pickup_month = 1"), path)
    assert [row.pickup_month for row in spark.read.parquet(path).collect()] == [1]


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    months = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, pickup_year int, pickup_month int")
    sinks.write_silver(months, path)
    sinks.write_silver(months.where("pickup_month = 1").withColumn("v", F.lit(9)), path, dynamic=True)
    assert {(row.pickup_month, row.v) for row in spark.read.parquet(path).collect()} == {(1, 9), (2, 2)}


def test_rejects_of_an_earlier_run_stay_unless_always(spark, tmp_path):
    path = str(tmp_path / "r")
    bad = stages.to_rejects(trips(spark, {"fare_amount": 0.0}, {}))
    none = stages.to_rejects(trips(spark, {}))
    assert sinks.write_reject(bad, path) is True
    assert sinks.write_reject(none, path) is False
    assert spark.read.schema(bad.schema).parquet(path).count() == 1
    assert sinks.write_reject(none, path, always=True) is True
    assert spark.read.schema(bad.schema).parquet(path).count() == 0


def test_reject_write_keeps_every_row_of_a_hot_reason(spark, tmp_path):
    path = str(tmp_path / "r")
    bad = stages.to_rejects(trips(spark, {"fare_amount": 0.0}).crossJoin(spark.range(5000)).drop("id"))
    sinks.write_reject(bad, path)
    assert spark.read.parquet(path).count() == 5000


def test_silver_report_counts_what_was_written(spark, sf_dir):
    layout = queries.bronze_lake(spark, sf_dir)
    report = stages.silver_stage(spark, layout)
    row = quality.quality_metrics(queries.tagged_trips(spark, sf_dir)).first()
    assert (report.total, report.valid) == (row.total_rows, row.valid_rows)
    assert sum(report.rejected.values()) == row.rejected_rows
    assert round(report.rejection_rate, 2) == row.rejection_rate_pct


def test_silver_report_of_a_run_without_rejects_or_without_rows(spark, tmp_path):
    layout = stages.Layout.under(str(tmp_path))
    good = trips(spark, {}, {})
    good.write.parquet(layout.bronze)
    assert stages.silver_stage(spark, layout) == stages.SilverReport(2, {})
    good.where("id < 0").write.mode("overwrite").parquet(layout.bronze)
    report = stages.silver_stage(spark, layout, always_write_rejects=True)
    assert (report.total, report.rejection_rate) == (0, 0.0)


def test_stages_can_run_again(spark, sf_dir):
    layout = queries.gold_lake(spark, sf_dir)
    first = {one.name: spark.read.parquet(layout.gold_table(one.name)).drop("gold_processed_at").collect() for one in summaries.SUMMARIES}
    stages.silver_stage(spark, layout, rebalance=True)
    stages.gold_stage(spark, layout)
    for name, rows in first.items():
        again = spark.read.parquet(layout.gold_table(name)).drop("gold_processed_at").collect()
        assert sorted(map(str, rows)) == sorted(map(str, again))


def test_registration_is_kept_and_partitions_follow_the_folders(spark, tmp_path):
    database, path = f"reg_{uuid.uuid4().hex}", str(tmp_path / "t")
    months = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, pickup_year int, pickup_month int")
    catalog.create_database(spark, database)
    catalog.create_database(spark, database)
    sinks.write_silver(months, path)
    catalog.register_silver(spark, database, path)
    assert spark.table(f"{database}.silver").count() == 2
    sinks.write_silver(months.where("pickup_month = 2"), path)
    catalog.register_silver(spark, database, path)
    assert [row.pickup_month for row in spark.table(f"{database}.silver").collect()] == [2]
    assert [row.table_name for row in catalog.list_tables(spark, database).collect()] == ["silver"]


def test_questions_give_the_same_over_registered_tables(spark, sf_dir):
    _, database = queries.registered_lake(spark, sf_dir)
    stored = analytics.registered_gold(spark, database)
    for name in ("daily_for_month", "rush_hour_slots", "payment_breakdown", "long_distance_hotspots"):
        question = analytics.QUESTIONS[name]
        derived = question(stages.to_gold(queries.silver_trips(spark, sf_dir)))
        assert question(stored).collect() == derived.collect()


def test_month_folder_is_the_one_scans_discover(spark, tmp_path):
    root = str(tmp_path)
    assert tables.month_folder(root).endswith("raw/yellow_tripdata/year=2024/month=01")
    trips(spark, {}).write.parquet(tables.month_folder(root))
    raw = tables.scan_raw(spark, root)
    assert tables.landing_month(raw).count() == 1
    assert tables.landing_month(raw, 2024, 2).count() == 0


def test_scratch_lies_in_the_folder_the_session_names(spark):
    shared = spark.conf.get(workspace.CHECKPOINT_SETTING)
    assert workspace.fresh_folder(spark, "x").startswith(shared)
    assert workspace.fresh_folder(spark, "x") != workspace.fresh_folder(spark, "x")


def test_saved_result_can_be_read_back(spark, tmp_path, capsys):
    result = spark.createDataFrame([("a", 1)], "name string, n int")
    saved = sinks.save_query_result(spark, "answer", result, str(tmp_path))
    assert saved.collect() == result.collect()
    assert "answer" in capsys.readouterr().out
    header = spark.read.text(f"{tmp_path}/answer").first().value
    assert header == "name,n"


@pytest.mark.parametrize("rebalance", [False, True])
def test_silver_write_keeps_all_rows(spark, sf_dir, tmp_path, rebalance):
    silver = queries.silver_trips(spark, sf_dir)
    sinks.write_silver(silver, str(tmp_path / "s"), rebalance=rebalance)
    assert tables.scan_silver(spark, str(tmp_path / "s")).count() == silver.count()


def test_registration_follows_columns_and_place(spark, tmp_path):
    database = queries.new_database(spark)
    catalog.create_database(spark, database)
    first, second = (str(tmp_path / name) for name in ("first", "second"))
    spark.range(3).write.parquet(first)
    catalog.register_table(spark, database, "t", first)
    spark.range(2).selectExpr("id", "id * 2 AS more").write.mode("append").parquet(first)
    catalog.register_table(spark, database, "t", first)
    assert set(spark.table(f"`{database}`.t").columns) == {"id", "more"} and spark.table(f"`{database}`.t").count() == 5
    spark.range(7).write.parquet(second)
    catalog.register_table(spark, database, "t", second)
    assert spark.table(f"`{database}`.t").count() == 7 and spark.read.parquet(first).count() == 5


def _registered_at(spark, tmp_path, frame, folder="first"):
    """A partitioned table under a name that carries a property, and the statements that name tables from here on."""
    database, path = queries.new_database(spark), str(tmp_path / folder)
    catalog.create_database(spark, database)
    frame.write.partitionBy("y", "m").parquet(path)
    catalog.register_table(spark, database, "t", path)
    spark.sql(f"ALTER TABLE {database}.t SET TBLPROPERTIES ('owner.note' = 'kept')")
    return database, path


def _note(spark, database):
    return [row.value for row in spark.sql(f"SHOW TBLPROPERTIES {database}.t").collect() if row.key == "owner.note"]


def test_a_table_grows_and_moves_under_its_name(spark, tmp_path, monkeypatch):
    months = spark.createDataFrame([(1, 2024, "a/b"), (2, 2024, None), (3, 2023, "x")], "v int, y int, m string")
    database, path = _registered_at(spark, tmp_path, months)
    issued, run = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *more, **named: issued.append(text) or run(self, text, *more, **named))

    months.selectExpr("v + 10 AS v", "v * 0.5D AS w", "y", "m").write.mode("append").partitionBy("y", "m").parquet(path)
    catalog.register_table(spark, database, "t", path)
    table = spark.table(f"{database}.t")
    assert table.columns == ["v", "w", "y", "m"] and table.where("w IS NOT NULL").count() == 3 and table.count() == 6
    assert sorted(row.v for row in table.where("m IS NULL").collect()) == [2, 12]

    second = str(tmp_path / "second")
    months.where("y = 2024").selectExpr("v + 100 AS v", "y", "m").write.partitionBy("y", "m").parquet(second)
    catalog.register_table(spark, database, "t", second)
    moved = sorted(tuple(row) for row in spark.table(f"{database}.t").select("v", "w", "m").collect())
    assert moved == [(101, None, "a/b"), (102, None, None)]
    assert not [text for text in issued if text.startswith(("DROP TABLE", "CREATE TABLE"))] and _note(spark, database) == ["kept"]
    assert spark.read.parquet(path).count() == 6

    before = len(issued)
    catalog.register_table(spark, database, "t", second)
    assert not [text for text in issued[before:] if "ADD COLUMNS" in text or "SET LOCATION" in text]


def test_what_cannot_be_altered_is_named_anew(spark, tmp_path):
    months = spark.createDataFrame([(1, 2024, "a")], "v int, y int, m string")
    database, path = _registered_at(spark, tmp_path, months)
    months.selectExpr("'text' AS v", "y", "m").write.mode("overwrite").partitionBy("y", "m").parquet(path)
    catalog.register_table(spark, database, "t", path)
    assert [tuple(row) for row in spark.table(f"{database}.t").collect()] == [("text", 2024, "a")]
    other = str(tmp_path / "other")
    months.selectExpr("'text' AS v", "y", "m").write.partitionBy("m").parquet(other)
    catalog.register_table(spark, database, "t", other)
    assert [row.y for row in spark.table(f"{database}.t").collect()] == [2024]
    catalog.register_table(spark, database, "t", other)
    assert spark.table(f"{database}.t").count() == 1


def test_bronze_is_gone_through_once_without_rejects_and_twice_with_them(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    for changes, passes in ((({}, {}), 1), (({}, {"fare_amount": 0.0}), 2)):
        sinks.write_bronze(trips(spark, *changes).drop("id"), layout.bronze)
        scanned = []
        writes = sinks.write_table
        sinks.write_table = lambda df, *a, **k: (scanned.append(a[0]), writes(df, *a, **k))[1]
        try:
            stages.silver_stage(spark, layout)
        finally:
            sinks.write_table = writes
        assert len(scanned) == passes


def test_saved_results_tell_empty_texts_from_nulls(spark, tmp_path, capsys):
    rows = [(1, ""), (2, None), (3, "a,b"), (4, 'say "x"'), (None, "\\")]
    saved = sinks.save_query_result(spark, "texts", spark.createDataFrame(rows, "n int, t string"), str(tmp_path))
    assert sorted(map(tuple, saved.collect()), key=str) == sorted(rows, key=str)
