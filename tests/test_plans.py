"""What the physical plans must and must not contain."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from meterline.checks import queries
from meterline.operators import summaries
from meterline.plans import analytics, stages
from meterline.sources import sinks, tables

STORAGE_FREE = [
    "dq_metrics", "dq_status", "rejects_by_reason", "daily_trip_summary", "location_trip_summary",
    *analytics.QUESTIONS, "check_columns", "validate_files", "parse_run_event", "audit_status_counts",
    "route_events", "render_notification", "alarm_task_failures",
]


def plan(df, mode="formatted") -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return queries.gold_lake(spark, sf_dir)


def test_silver_is_one_pass_without_shuffle_and_prunes_row_groups(spark, lake):
    text = plan(stages.to_silver(tables.scan_bronze(spark, lake.bronze)))
    assert "Exchange" not in text
    assert "GreaterThanOrEqual(passenger_count" in text and "IsNotNull(tpep_dropoff_datetime)" in text


def test_gold_reads_silver_once_and_only_what_it_needs(spark, lake):
    text = plan(summaries.summarise_all(tables.scan_silver(spark, lake.silver)), "simple")
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "partial_count" in text
    assert "source_file" not in text and "tolls_amount" not in text


def test_month_filters_prune_partitions(spark, lake):
    gold = {summaries.DAILY.name: spark.read.parquet(lake.gold_table(summaries.DAILY.name))}
    assert "(pickup_year#" in plan(analytics.daily_for_month(gold)).split("PartitionFilters")[1].splitlines()[0]
    raw = tables.landing_month(tables.scan_raw(spark, lake.raw))
    assert "(year#" in plan(raw).split("PartitionFilters")[1].splitlines()[0]


def test_top_lists_do_not_sort_everything(spark, lake):
    gold = {summaries.LOCATION.name: spark.read.parquet(lake.gold_table(summaries.LOCATION.name))}
    assert "TakeOrderedAndProject" in plan(analytics.busiest_locations(gold), "simple")


def test_shares_need_no_unpartitioned_window(spark, lake):
    gold = {summaries.PAYMENT.name: spark.read.parquet(lake.gold_table(summaries.PAYMENT.name))}
    text = plan(analytics.payment_breakdown(gold), "simple")
    assert "Window" not in text and "Subquery" in text


def test_shares_gather_no_rows_in_one_task(spark, lake):
    gold = {summaries.PAYMENT.name: spark.read.parquet(lake.gold_table(summaries.PAYMENT.name))}
    assert "collect_list" not in plan(analytics.payment_breakdown(gold), "simple")


def test_the_total_of_shares_reads_the_exchange_of_the_rows(spark, sf_dir):
    shares = entry.queries()["payment_breakdown"](spark, sf_dir)
    assert shares.collect()
    ran = shares._jdf.queryExecution().executedPlan().toString()
    total = ran[ran.index("Subquery subquery#") :].split("== Initial Plan ==")[0]
    assert "ReusedExchange" in total and "FileScan" not in total


@pytest.mark.parametrize("name", STORAGE_FREE)
def test_no_python_and_no_cross_join_in_the_plan(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir), "simple")
    for unwanted in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_gold_tables_are_one_file_per_partition(spark, lake, tmp_path):
    path = str(tmp_path / "hourly")
    hourly = summaries.hourly_trip_summary(tables.scan_silver(spark, lake.silver))
    sinks.write_gold_table(hourly, path, summaries.HOURLY.stored_by)
    files = spark.read.parquet(path).select("pickup_year", "pickup_month", "_metadata.file_path").distinct()
    assert files.count() == files.select("pickup_year", "pickup_month").distinct().count()
