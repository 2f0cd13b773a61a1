"""The given tables as the engine's inputs: trips, run events, arrivals, file manifests and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.config import (
    BRONZE_JOB,
    GOLD_JOB,
    LANDING_PREFIX,
    REQUIRED_COLUMNS,
    SILVER_JOB,
    STAGE_EVENT_SOURCE,
    STAGE_EVENT_TYPE,
)
from meterline.operators.alarms import ALARM_RULES

_DAY = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds(value: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), value.cast("decimal(18,6)"))


def trips(lineitem: DataFrame) -> DataFrame:
    """Order lines as raw trips, with every quality rule broken by some of them and nulls wherever one may be."""
    part = lambda n: F.col("l_partkey") % n
    price = F.col("l_extendedprice")
    days = F.when(part(499) == 3, 0).when(part(499) == 4, 13_880).otherwise(8_401)
    minute_of_day = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 211) % 1440
    pickup = F.when(
        ~(part(101) == 7),
        F.col("l_shipdate") + _seconds(days.cast("bigint") * _DAY + minute_of_day * 60 + part(60)),
    )
    ride = _seconds(F.col("l_quantity") * 47 + F.col("l_suppkey") % 60)
    landed = F.col("l_shipdate") + _seconds(F.lit(8_401 * _DAY))
    # Some distances have more decimals than any unit one would add them up in.
    distance = F.col("l_quantity") / 4 + F.when(part(97) == 5, F.col("l_linenumber") * F.lit(4e-7)).otherwise(0.0)
    fare = F.when(part(131) == 6, -price).otherwise(price / 20)
    total = price / 20 * (1 + F.col("l_discount")) + F.col("l_tax") * 100
    return lineitem.select(
        "*",
        pickup.alias("tpep_pickup_datetime"),
    ).select(
        (F.col("l_suppkey") % 2 + 1).alias("VendorID"),
        "tpep_pickup_datetime",
        F.when(part(103) == 9, None)
        .when(part(107) == 11, F.col("tpep_pickup_datetime"))
        .otherwise(F.col("tpep_pickup_datetime") + ride)
        .alias("tpep_dropoff_datetime"),
        F.when(~(part(109) == 13), F.col("l_linenumber") - F.when(part(113) == 1, 7).otherwise(0))
        .cast("double")
        .alias("passenger_count"),
        F.when(part(139) == 17, None).when(part(127) == 2, 0.0).when(part(127) == 5, 500.0).otherwise(distance).alias("trip_distance"),
        F.col("l_suppkey").alias("PULocationID"),
        part(265).alias("DOLocationID"),
        F.when(~(F.col("l_orderkey") % 167 == 25), F.col("l_orderkey") % 6).alias("payment_type"),
        F.when(~(part(151) == 22), fare).alias("fare_amount"),
        F.when(~(part(163) == 24), price / 20 * F.col("l_discount")).alias("tip_amount"),
        (F.col("l_tax") * 100).alias("tolls_amount"),
        F.when(part(157) == 23, None).when(part(137) == 8, 0.0).otherwise(total).alias("total_amount"),
        F.year(landed).alias("year"),
        F.month(landed).alias("month"),
    )


def run_events(events: DataFrame) -> DataFrame:
    """Stage events as JSON text in ``body``, with ``event_id`` for their order and ``ts`` for their time."""
    job = F.element_at(F.array(F.lit(BRONZE_JOB), F.lit(SILVER_JOB), F.lit(GOLD_JOB)), (F.col("user_id") % 3 + 1).cast("int"))
    state = (
        F.when(F.col("event_type").isin("purchase", "view"), "SUCCEEDED")
        .when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "click", "STOPPED")
        .otherwise("RUNNING")
    )
    day = F.date_format("ts", "yyyy-MM-dd")
    detail = F.struct(
        job.alias("jobName"),
        state.alias("state"),
        F.col("user_id").cast("string").alias("jobRunId"),
        F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("event "), F.col("event_id"))).alias("message"),
    )
    body = F.struct(
        F.lit(STAGE_EVENT_SOURCE).alias("source"),
        F.lit(STAGE_EVENT_TYPE).alias("detail-type"),
        F.concat(day, F.lit("T00:00:00Z")).alias("time"),
        detail.alias("detail"),
    )
    return events.select("event_id", "ts", F.to_json(body).alias("body"))


def metrics(events: DataFrame) -> DataFrame:
    """One metric row per event; each event feeds one rule and one of that rule's dimensions."""
    rules = F.array(
        *[
            F.struct(
                F.lit(rule.namespace).alias("namespace"),
                F.lit(rule.metric).alias("metric"),
                F.array(*[F.lit(name) for name in rule.dimensions]).alias("dimensions"),
            )
            for rule in ALARM_RULES
        ]
    )
    rule = F.element_at(rules, (F.col("event_id") % len(ALARM_RULES) + 1).cast("int"))
    names = F.col("rule.dimensions")
    return events.withColumn("rule", rule).select(
        "ts",
        F.col("rule.namespace").alias("namespace"),
        F.col("rule.metric").alias("metric"),
        F.element_at(names, (F.col("user_id") % F.size(names) + 1).cast("int")).alias("dimension"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("value"),
    )


def _landed_key() -> Column:
    prefix = F.when(F.col("doc_id") % 11 == 3, "landing/").otherwise(LANDING_PREFIX)
    suffix = F.when(F.col("doc_id") % 13 == 5, ".csv").otherwise(".parquet")
    return F.concat(prefix, F.lit("year=2024/f"), F.col("doc_id"), suffix)


def arrivals(documents: DataFrame) -> DataFrame:
    """Arrival events as JSON text: keys percent-encoded, some events with two records, some with none."""
    encoded = F.url_encode(_landed_key())
    record = lambda key: F.struct(
        F.struct(
            F.struct(F.lit("raw-bucket").alias("name")).alias("bucket"),
            F.struct(key.alias("key"), F.col("n_chars").alias("size")).alias("object"),
        ).alias("s3")
    )
    records = (
        F.when(F.col("doc_id") % 17 == 0, None)
        .when(F.col("doc_id") % 5 == 0, F.array(record(encoded), record(F.concat(encoded, F.lit(".copy")))))
        .otherwise(F.array(record(encoded)))
    )
    return documents.select(F.to_json(F.struct(records.alias("Records"))).alias("body"))


def manifest(documents: DataFrame) -> DataFrame:
    """A manifest with every kind of finding in it: one file per document."""
    names = F.array(*[F.lit(name) for name in REQUIRED_COLUMNS])
    kept = F.filter(
        names,
        lambda name, index: ~(
            ((F.col("doc_id") % 19 == 4) & (index == F.col("doc_id") % 11))
            | ((F.col("doc_id") % 23 == 6) & (index == F.col("doc_id") % 7))
        ),
    )
    return documents.select(
        F.lit("raw-bucket").alias("bucket"),
        _landed_key().alias("key"),
        F.col("n_chars").alias("size"),
        F.when(F.col("doc_id") % 31 == 8, F.transform(kept, F.lower)).otherwise(kept).alias("columns"),
        F.when(F.col("doc_id") % 29 == 7, 0).otherwise(F.length("text")).cast("bigint").alias("n_rows"),
        F.when(F.col("doc_id") % 37 == 9, F.lit("not a parquet file")).alias("read_error"),
    )
