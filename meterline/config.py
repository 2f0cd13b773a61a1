"""Paths, bounds and session settings shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

# Settings the results or the plans rely on. Partition counts are deliberately absent: adaptive
# execution coalesces from the cluster's own setting, so none is fixed for one data size here.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "meterline", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; ``master`` is only for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class QualityBounds:
    """The limits a trip record must respect to be accepted."""

    min_passengers: int = 1
    max_passengers: int = 6
    min_distance: float = 0.0
    max_distance: float = 500.0
    min_fare: float = 0.0
    max_fare: float = 10000.0
    min_total: float = 0.0
    first_year: int = 2009
    last_year: int = 2030


@dataclass(frozen=True)
class Layout:
    """Where each layer of the lake lives."""

    raw: str
    bronze: str
    silver: str
    reject: str
    gold: str
    audit: str
    notices: str
    outbox: str

    @classmethod
    def under(cls, base: str) -> Layout:
        base = base.rstrip("/")
        return cls(
            raw=f"{base}/landing",
            bronze=f"{base}/curated/bronze",
            silver=f"{base}/curated/silver",
            reject=f"{base}/reject/silver",
            gold=f"{base}/gold",
            audit=f"{base}/control/audit",
            notices=f"{base}/control/notices",
            outbox=f"{base}/control/outbox",
        )

    def gold_table(self, name: str) -> str:
        return f"{self.gold}/{name}"

    @property
    def gold_states(self) -> str:
        """What each month adds to the gold tables."""
        return f"{self.gold.rstrip('/')}_states"


# Landing layout, the columns every landed file must carry, and the smallest file size.
LANDING_PREFIX = "raw/yellow_tripdata/"
LANDING_SUFFIX = ".parquet"
MIN_FILE_BYTES = 1024
REQUIRED_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
)

# The types landed columns are read as, whatever a month's file has them as.
LANDING_TYPES = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
}

# What a stage's state-change event looks like and which states the rules react to.
STAGE_EVENT_SOURCE = "aws.glue"
STAGE_EVENT_TYPE = "Glue Job State Change"
SUCCESS_STATES = ("SUCCEEDED",)
FAILURE_STATES = ("FAILED", "ERROR", "STOPPED")

BRONZE_JOB = "bronze-job"
SILVER_JOB = "silver-job"
GOLD_JOB = "gold-job"
RUN_JOB = "trip-run"
