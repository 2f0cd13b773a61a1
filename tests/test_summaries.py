from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterline.checks.queries import silver_trips
from meterline.operators import summaries
from meterline.plans import analytics
from meterline.plans.stages import to_gold, to_silver
from rows import trips


def _rows(df, drop="gold_processed_at"):
    return Counter(tuple(row) for row in df.drop(drop).collect())


@pytest.mark.parametrize("summary", summaries.SUMMARIES, ids=lambda summary: summary.name)
def test_one_scan_for_all_gives_what_each_gives_alone(spark, sf_dir, summary):
    silver = silver_trips(spark, sf_dir)
    combined = summaries.pick_summary(summaries.summarise_all(silver), summary)
    assert combined.columns == summaries.summarise(silver, summary).columns
    assert _rows(combined) == _rows(summaries.summarise(silver, summary))


def test_every_summary_counts_every_trip(spark, sf_dir):
    silver = silver_trips(spark, sf_dir)
    gold = to_gold(silver)
    totals = {gold[one.name].agg(F.sum("total_trips")).first()[0] for one in summaries.SUMMARIES}
    assert totals == {silver.count()}


def test_a_null_key_is_a_group_of_its_own(spark):
    silver = to_silver(trips(spark, {"payment_type": None}, {"payment_type": None, "tip_amount": None}, {}))
    for frame in (
        summaries.payment_type_summary(silver),
        summaries.pick_summary(summaries.summarise_all(silver), summaries.PAYMENT),
    ):
        found = {row.payment_type: (row.total_trips, row.avg_tip) for row in frame.collect()}
        assert found == {None: (2, 2.0), 1: (1, 2.0)}
    located = summaries.summarise_all(to_silver(trips(spark, {"PULocationID": None}, {})))
    assert {row.PULocationID for row in summaries.pick_summary(located, summaries.LOCATION).collect()} == {None, 10}


def test_unknown_payment_methods_are_not_merged(spark):
    gold = to_gold(to_silver(trips(spark, {"payment_type": None}, {"payment_type": 0}, {"payment_type": 5}, {})))
    rows = analytics.payment_breakdown(gold).collect()
    assert [row.payment_method for row in rows].count("Unknown") == 3
    assert [row.trip_percentage for row in rows] == [25.0] * 4


def test_tip_rate_is_null_where_the_average_fare_is_zero(spark):
    payment = spark.createDataFrame([(1, 2.0, 0.0), (2, 1.0, 4.0)], "payment_type bigint, avg_tip double, avg_fare double")
    rows = analytics.card_vs_cash_tips({summaries.PAYMENT.name: payment}).collect()
    assert [(row.payment_method, row.tip_percentage) for row in rows] == [("Credit Card", None), ("Cash", 25.0)]


def test_results_come_sorted(spark, sf_dir):
    gold = to_gold(silver_trips(spark, sf_dir))
    revenue = [row.total_revenue for row in analytics.top_revenue_days(gold).collect()]
    assert revenue == sorted(revenue, reverse=True)
    dates = [row.pickup_date for row in analytics.daily_for_month(gold).collect()]
    assert dates == sorted(dates)
    assert analytics.daily_for_month_head(gold).count() == 5
