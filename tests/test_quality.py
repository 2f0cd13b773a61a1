from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline.config import QualityBounds
from meterline.operators import quality
from meterline.plans.stages import to_rejects, to_silver
from rows import trips

NAN = float("nan")
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def _ride(pickup: dt.datetime) -> dict:
    return {PICKUP: pickup, DROPOFF: pickup + dt.timedelta(minutes=5)}


CASES = [
    *[({"passenger_count": value}, reason) for value, reason in [
        (0.5, "invalid_passenger_count"), (1.0, None), (1.5, None), (6.0, None),
        (6.5, "invalid_passenger_count"), (None, "invalid_passenger_count"), (NAN, "invalid_passenger_count"),
    ]],
    *[({"trip_distance": value}, reason) for value, reason in [
        (0.0, "invalid_trip_distance"), (0.01, None), (499.99, None), (500.0, "invalid_trip_distance"),
        (None, "invalid_trip_distance"), (NAN, "invalid_trip_distance"),
    ]],
    *[({"fare_amount": value}, reason) for value, reason in [
        (0.0, "invalid_fare_amount"), (0.01, None), (9999.99, None), (10000.0, "invalid_fare_amount"),
        (None, "invalid_fare_amount"), (NAN, "invalid_fare_amount"),
    ]],
    *[({"total_amount": value}, reason) for value, reason in [
        (0.0, "invalid_total_amount"), (0.01, None), (1e12, None), (None, "invalid_total_amount"), (NAN, None),
    ]],
    ({PICKUP: None}, "null_pickup_datetime"),
    ({DROPOFF: None}, "null_dropoff_datetime"),
    ({DROPOFF: dt.datetime(2024, 1, 15, 8, 0, 0)}, "dropoff_before_pickup"),
    ({DROPOFF: dt.datetime(2024, 1, 15, 8, 0, 1)}, None),
    (_ride(dt.datetime(2008, 12, 31, 23, 59, 59)), "pickup_year_too_old"),
    (_ride(dt.datetime(2009, 1, 1)), None),
    (_ride(dt.datetime(2030, 12, 31, 23, 59, 59)), None),
    (_ride(dt.datetime(2031, 1, 1)), "pickup_year_future"),
    ({"passenger_count": 0.0, "fare_amount": -1.0, PICKUP: None}, "invalid_passenger_count"),
    ({"fare_amount": -1.0, PICKUP: None}, "invalid_fare_amount"),
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The edge rows in Parquet, so that pushed filters act on them."""
    path = str(tmp_path_factory.mktemp("edge") / "rows")
    trips(spark, *[change for change, _ in CASES]).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def test_each_row_gets_the_first_reason_that_applies(stored):
    tagged = quality.tag_quality(stored)
    found = {row.id: row[quality.REASON] for row in tagged.collect()}
    assert found == {number: reason for number, (_, reason) in enumerate(CASES)}


def test_valid_and_rejected_rows_are_all_rows(stored):
    valid = {row.id for row in to_silver(stored).collect()}
    rejected = {row.id for row in to_rejects(stored).collect()}
    assert valid == {number for number, (_, reason) in enumerate(CASES) if reason is None}
    assert rejected == {number for number, (_, reason) in enumerate(CASES) if reason is not None}


def test_pruning_keeps_a_nan_total_whose_file_statistics_hide_it(spark, tmp_path):
    """Writers may leave NaN out of a column's minimum and maximum."""
    import pyarrow.parquet

    path = tmp_path / "rows.parquet"
    pyarrow.parquet.write_table(trips(spark, {"total_amount": -1.0}, {"total_amount": NAN}).toArrow(), path)
    assert [row.id for row in to_silver(spark.read.parquet(str(path))).collect()] == [1]


def test_bounds_can_be_changed(spark):
    tagged = quality.tag_quality(
        trips(spark, {"passenger_count": 7.0}), quality.trip_rules(QualityBounds(max_passengers=8))
    )
    assert quality.valid_rows(tagged).count() == 1


def test_metrics_of_no_rows(spark):
    row = quality.quality_metrics(quality.tag_quality(trips(spark, {}).where(F.lit(False)))).first()
    assert (row.total_rows, row.valid_rows, row.rejected_rows, row.rejection_rate_pct) == (0, 0, 0, 0.0)


def test_metrics_count_each_row_once(stored):
    row = quality.quality_metrics(quality.tag_quality(stored)).first()
    rejected = sum(1 for _, reason in CASES if reason)
    assert (row.total_rows, row.rejected_rows) == (len(CASES), rejected)
    assert row.rejection_rate_pct == round(100 * rejected / len(CASES), 2)
