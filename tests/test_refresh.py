from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterline.checks.queries import silver_trips
from meterline.config import Layout
from meterline.operators import summaries
from meterline.plans import stages
from meterline.sources import sinks, tables
from rows import trips


def _gold(spark, layout):
    return {
        one.name: Counter(
            tuple(row) for row in spark.read.parquet(layout.gold_table(one.name)).select(*one.columns()[:-1]).collect()
        )
        for one in summaries.SUMMARIES
    }


def _full(spark, layout, tmp_path):
    """Gold of the plain stage over the same silver, elsewhere."""
    other = Layout(**{**vars(layout), "gold": str(tmp_path / "plain")})
    stages.gold_stage(spark, other)
    return _gold(spark, other)


def _month(year, month, day=5, **changes):
    start = dt.datetime(year, month, day, 8)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=30), **changes}


def _silver(spark, *changes):
    return stages.to_silver(trips(spark, *changes))


@pytest.mark.parametrize("summary", summaries.SUMMARIES, ids=lambda summary: summary.name)
def test_states_of_months_merge_to_the_summary(spark, sf_dir, summary):
    silver = silver_trips(spark, sf_dir)
    merged = summaries.merge_states(summaries.month_states(silver), summary)
    plain = summaries.summarise(silver, summary).select(*summary.columns())
    assert merged.columns == plain.columns
    rows = lambda df: Counter(tuple(row) for row in df.drop("gold_processed_at").collect())
    assert rows(merged) == rows(plain)


def test_states_keep_digits_nulls_and_values_no_decimal_holds(spark):
    silver = _silver(
        spark,
        _month(2024, 1, tip_amount=None, payment_type=None),
        _month(2024, 1, trip_distance=0.1234567890123, PULocationID=None),
        _month(2024, 2, tip_amount=1e30),
        _month(2024, 2, trip_distance=1e-7, tip_amount=None),
    )
    states = summaries.month_states(silver)
    for summary in summaries.SUMMARIES:
        plain = summaries.summarise(silver, summary).select(*summary.columns()[:-1])
        assert Counter(map(tuple, summaries.merge_states(states, summary).select(*summary.columns()[:-1]).collect())) == Counter(
            map(tuple, plain.collect())
        )


def test_new_changed_and_emptied_months(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "lake"))
    one, two, three = ((2024, number) for number in (1, 2, 3))
    sinks.write_silver(_silver(spark, _month(*one), _month(*one, day=6, fare_amount=0.1), _month(*two)), layout.silver)
    stages.refresh_gold(spark, layout)
    assert _gold(spark, layout) == _full(spark, layout, tmp_path)

    sinks.write_silver(_silver(spark, _month(*three, fare_amount=7.35), _month(*two, tip_amount=None)), layout.silver, dynamic=True)
    stages.refresh_gold(spark, layout, [three, two, three])
    assert _gold(spark, layout) == _full(spark, layout, tmp_path)

    sinks.write_silver(_silver(spark, _month(*one), _month(*three)), layout.silver)
    stages.refresh_gold(spark, layout, [two])
    stages.refresh_gold(spark, layout, [one, three])
    refreshed = _gold(spark, layout)
    assert refreshed == _full(spark, layout, tmp_path)
    stages.refresh_gold(spark, layout, [one, three])
    stages.refresh_gold(spark, layout, [])
    assert _gold(spark, layout) == refreshed


def test_a_month_that_is_refreshed_is_the_only_one_read(spark, sf_dir, tmp_path):
    sinks.write_silver(silver_trips(spark, sf_dir), str(tmp_path / "s"))
    silver = tables.scan_silver(spark, str(tmp_path / "s"))
    year, month = silver.select(*summaries.MONTH).first()
    states = summaries.month_states(silver.where(stages.in_months([(year, month)])), [(year, month)])
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "pickup_year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = states.where(F.col(summaries.SET_NAME) != summaries.MONTH_MARK).select(*summaries.MONTH).distinct().collect()
    assert [tuple(row) for row in files] == [(year, month)]


def test_months_need_the_states_of_the_others(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "lake"))
    sinks.write_silver(_silver(spark, _month(2024, 1), _month(2024, 2)), layout.silver)
    with pytest.raises(stages.NoStates):
        stages.refresh_gold(spark, layout, [(2024, 1)])
    stages.refresh_gold(spark, layout)
    # A plain run makes states stale, so it takes them away.
    stages.gold_stage(spark, layout)
    with pytest.raises(stages.NoStates):
        stages.refresh_gold(spark, layout, [(2024, 1)])
    stages.refresh_gold(spark, layout)
    stages.refresh_gold(spark, layout, [(2024, 1)])
    assert _gold(spark, layout) == _full(spark, layout, tmp_path)
