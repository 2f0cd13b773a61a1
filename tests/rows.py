"""Hand-written trips."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "id int, VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, PULocationID bigint, DOLocationID bigint, "
    "payment_type bigint, fare_amount double, tip_amount double, tolls_amount double, total_amount double"
)

GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 1, 15, 8, 0, 0),
    "tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 8, 30, 0),
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 10.0,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "total_amount": 12.0,
}


def trips(spark: SparkSession, *changes: dict) -> DataFrame:
    """One acceptable trip per argument, changed as the argument says, numbered from 0."""
    rows = [tuple({"id": number, **GOOD, **change}.values()) for number, change in enumerate(changes)]
    return spark.createDataFrame(rows, SCHEMA)
