"""Silver columns: types, pickup date parts, trip duration and rounded money."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import elapsed_minutes
from meterline.functions.exact import round_cents
from meterline.operators.quality import REASON, STATUS

SILVER_TYPES = {
    "passenger_count": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
}

MONEY = ("fare_amount", "tip_amount", "tolls_amount", "total_amount")

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def cast_types(df: DataFrame) -> DataFrame:
    """Silver types. A value its type cannot hold becomes null instead of failing the job."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in SILVER_TYPES.items()})


def add_pickup_date(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_date", F.to_date(PICKUP))


def add_pickup_year(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_year", F.year(PICKUP))


def add_pickup_month(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_month", F.month(PICKUP))


def add_pickup_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_hour", F.hour(PICKUP))


def add_pickup_dayofweek(df: DataFrame) -> DataFrame:
    """1 is Sunday, 7 is Saturday."""
    return df.withColumn("pickup_dayofweek", F.dayofweek(PICKUP))


def add_trip_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_duration_minutes", elapsed_minutes(F.col(PICKUP), F.col(DROPOFF)))


def round_money(df: DataFrame) -> DataFrame:
    return df.withColumns({name: round_cents(F.col(name)) for name in MONEY})


def add_processed_time(df: DataFrame) -> DataFrame:
    return df.withColumn("silver_processed_at", F.current_timestamp())


def drop_quality_columns(df: DataFrame) -> DataFrame:
    return df.drop(STATUS, REASON)


def shape_trips(valid: DataFrame) -> DataFrame:
    """Accepted rows in silver form; every step is a projection, so Catalyst folds them into one."""
    steps = (
        cast_types,
        add_pickup_date,
        add_pickup_year,
        add_pickup_month,
        add_pickup_hour,
        add_pickup_dayofweek,
        add_trip_duration,
        round_money,
        add_processed_time,
        drop_quality_columns,
    )
    for step in steps:
        valid = valid.transform(step)
    return valid
