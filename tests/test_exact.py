from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.functions.exact import exact_sum, round_cents, rounded_mean, rounded_sum
from meterline.operators import shaping
from rows import trips


def _one(df, column):
    return df.agg(column.alias("x")).first().x


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-2e8, 2e8) | st.integers(-10**9, 10**9).map(lambda n: n / 200), min_size=1, max_size=400))
def test_round_cents_is_round(spark, values):
    df = spark.createDataFrame([(value,) for value in values], "x double")
    rows = df.select("x", F.round("x", 2).alias("expected"), round_cents(F.col("x")).alias("found")).collect()
    assert all(repr(row.found) == repr(row.expected) for row in rows)


def test_round_cents_on_many_ties(spark):
    x = (F.col("id") - 500_000) / F.lit(200.0)
    differing = spark.range(1_000_000).select(x.alias("x")).where(~F.round("x", 2).eqNullSafe(round_cents(F.col("x"))))
    assert differing.count() == 0


def test_sum_does_not_depend_on_order(spark):
    values = [(0.1,), (0.2,), (0.3,), (1e9 + 0.01,), (-1e9,)] * 50
    forward = spark.createDataFrame(values, "x double").coalesce(1)
    backward = spark.createDataFrame(values[::-1], "x double").coalesce(1)
    assert _one(forward, exact_sum(F.col("x"))) == _one(backward, exact_sum(F.col("x"))) == 30.5


def test_mean_rounds_half_up_and_skips_nulls(spark):
    df = spark.createDataFrame([(2.67,), (2.68,), (None,)], "x double")
    assert _one(df, rounded_mean(F.col("x"))) == float(Decimal("2.675").quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_nothing_to_add_gives_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert _one(df, rounded_sum(F.col("x"))) is None
    assert _one(df, rounded_mean(F.col("x"))) is None
    assert _one(df.where(F.lit(False)), rounded_mean(F.col("x"))) is None


def test_values_units_cannot_hold_use_the_double_sum(spark):
    large = spark.createDataFrame([(1e17,), (1e17,), (0.25,)], "x double")
    assert _one(large, exact_sum(F.col("x"))) == 2e17
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert str(_one(nan, exact_sum(F.col("x")))) == "nan"
    infinite = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    assert _one(infinite, exact_sum(F.col("x"))) == float("inf")


def test_a_total_beyond_bigint_uses_the_double_sum(spark):
    df = spark.range(3000).select(F.lit(9e13).alias("x"))
    assert _one(df, exact_sum(F.col("x"))) == 3000 * 9e13


def test_no_digit_is_lost_in_large_groups(spark):
    for value, expected in ((4e-7, 0.4), (1.2345674, 1234567.4), (-0.1234567891234, -123456.7891234)):
        assert _one(spark.range(1_000_000).select(F.lit(value).alias("x")), exact_sum(F.col("x"))) == expected


def test_values_of_all_kinds_add_up_in_any_order(spark):
    values = [(0.01,), (1e13,), (3e-9,), (-1e13,), (12345.678901,), (None,), (-0.0,)] * 40
    expected = float(sum(Decimal(repr(value)) for (value,) in values if value is not None))
    for order in (values, values[::-1]):
        assert abs(_one(spark.createDataFrame(order, "x double").coalesce(1), exact_sum(F.col("x"))) - expected) < 1e-9


def test_silver_types_and_parts(spark):
    row = shaping.shape_trips(
        trips(
            spark,
            {
                "passenger_count": 1.9,
                "tpep_pickup_datetime": dt.datetime(2024, 1, 14, 0, 0, 0, 100_000),
                "tpep_dropoff_datetime": dt.datetime(2024, 1, 14, 0, 1, 0, 900_000),
                "fare_amount": 1.005,
                "tip_amount": None,
            },
        )
    ).first()
    assert row.passenger_count == 1
    assert (row.pickup_date, row.pickup_year, row.pickup_month, row.pickup_hour) == (dt.date(2024, 1, 14), 2024, 1, 0)
    assert row.pickup_dayofweek == 1  # a Sunday
    assert row.trip_duration_minutes == 1.0
    assert row.fare_amount == 1.01
    assert row.tip_amount is None


def test_a_value_its_type_cannot_hold_becomes_null(spark):
    row = shaping.cast_types(trips(spark, {"passenger_count": 1e12})).first()
    assert row.passenger_count is None
