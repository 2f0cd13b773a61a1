"""Gold summaries: four groupings of the same silver rows.

Each summary can be built on its own (one scan, only the columns it needs) or all four together with
grouping sets (one scan, one shuffle of per-task partial results), which is what the gold stage stores.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.exact import SUM_PARTS, rounded_mean, rounded_sum, sum_of_parts, sum_parts

SET_NAME = "summary_name"

# Distances are not rounded in silver; most have two decimals, others take the wide way, so none loses digits.
DISTANCE_PLACES = 2


def _measures() -> dict[str, Column]:
    fare, tip, total = F.col("fare_amount"), F.col("tip_amount"), F.col("total_amount")
    distance, minutes = F.col("trip_distance"), F.col("trip_duration_minutes")
    return {
        "total_trips": F.count(F.lit(1)),
        "total_passengers": F.sum("passenger_count"),
        "avg_fare": rounded_mean(fare),
        "total_fare": rounded_sum(fare),
        "avg_tip": rounded_mean(tip),
        "total_tip": rounded_sum(tip),
        "avg_distance": rounded_mean(distance, DISTANCE_PLACES),
        "total_distance": rounded_sum(distance, DISTANCE_PLACES),
        "avg_duration_minutes": rounded_mean(minutes),
        "total_revenue": rounded_sum(total),
        "max_fare": F.round(F.max(fare), 2),
        "min_fare": F.round(F.min(fare), 2),
    }


@dataclass(frozen=True)
class Summary:
    """A gold table: its keys, its measures, and how it is stored."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    stored_by: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        return [*self.keys, *self.measures, "gold_processed_at"]


DAILY = Summary(
    "daily_trip_summary",
    ("pickup_date", "pickup_year", "pickup_month"),
    (
        "total_trips", "total_passengers", "avg_fare", "total_fare", "avg_tip", "total_tip",
        "avg_distance", "total_distance", "avg_duration_minutes", "total_revenue",
    ),
    stored_by=("pickup_year", "pickup_month"),
)
HOURLY = Summary(
    "hourly_trip_summary",
    ("pickup_year", "pickup_month", "pickup_hour"),
    ("total_trips", "avg_fare", "avg_distance", "avg_duration_minutes", "total_revenue"),
    stored_by=("pickup_year", "pickup_month"),
)
LOCATION = Summary(
    "location_trip_summary",
    ("PULocationID",),
    ("total_trips", "avg_fare", "avg_distance", "avg_duration_minutes", "total_revenue", "avg_tip"),
)
PAYMENT = Summary(
    "payment_type_summary",
    ("payment_type",),
    ("total_trips", "avg_fare", "avg_tip", "total_revenue", "max_fare", "min_fare"),
)
SUMMARIES = (DAILY, HOURLY, LOCATION, PAYMENT)


def summarise(silver: DataFrame, summary: Summary) -> DataFrame:
    """One summary. Not sorted: order is a matter for whoever reads the table."""
    measures = _measures()
    grouped = silver.groupBy(*summary.keys).agg(*[measures[name].alias(name) for name in summary.measures])
    return grouped.withColumn("gold_processed_at", F.current_timestamp())


def daily_trip_summary(silver: DataFrame) -> DataFrame:
    return summarise(silver, DAILY)


def hourly_trip_summary(silver: DataFrame) -> DataFrame:
    return summarise(silver, HOURLY)


def location_trip_summary(silver: DataFrame) -> DataFrame:
    return summarise(silver, LOCATION)


def payment_type_summary(silver: DataFrame) -> DataFrame:
    return summarise(silver, PAYMENT)


def summarise_all(silver: DataFrame, summaries: tuple[Summary, ...] = SUMMARIES) -> DataFrame:
    """All summaries in one frame, each row named after the summary it belongs to.

    Rows are combined per task before the shuffle, so what moves is a task's distinct dates, hours,
    locations and payment types rather than trips, and a key with very many trips is no larger than
    any other. ``grouping_id`` tells a key that is null in the data from one a summary does not use.
    """
    keys = list(dict.fromkeys(key for summary in summaries for key in summary.keys))
    measures = _measures()
    grouped = silver.groupingSets([list(summary.keys) for summary in summaries], *keys).agg(
        F.grouping_id(*keys).alias("grouping"),
        *[column.alias(name) for name, column in measures.items()],
    )
    name = F.lit(None).cast("string")
    for summary in summaries:
        name = F.when(F.col("grouping") == _grouping_id(keys, summary.keys), F.lit(summary.name)).otherwise(name)
    return (
        grouped.withColumn(SET_NAME, name)
        .drop("grouping")
        .withColumn("gold_processed_at", F.current_timestamp())
    )


def _grouping_id(all_keys: list[str], used: tuple[str, ...]) -> int:
    """The id Spark gives the set that groups by ``used``: one bit per key, set where it is left out."""
    return sum(1 << position for position, key in enumerate(reversed(all_keys)) if key not in used)


# --- states by month --------------------------------------------------------------------------------------

MONTH = ("pickup_year", "pickup_month")
# Rows of this name hold no summary. One stands for each month that was asked for, so that a month without trips
# replaces what was stored for it as well.
MONTH_MARK = "month"

# Sums of which a state keeps the parts, with the decimals most values have.
_SUMMED = {
    "fare": ("fare_amount", 2),
    "tip": ("tip_amount", 2),
    "total": ("total_amount", 2),
    "distance": ("trip_distance", DISTANCE_PLACES),
    "minutes": ("trip_duration_minutes", 2),
}


def _state_keys() -> list[str]:
    return list(dict.fromkeys([*MONTH, *(key for summary in SUMMARIES for key in summary.keys)]))


def month_states(silver: DataFrame, months: Sequence[tuple[int, int]] = ()) -> DataFrame:
    """What each month adds to each summary: counts, extremes and the parts of sums, nothing rounded or divided.

    One scan of ``silver``, combined per task before the shuffle. States of different months merge to the summaries of
    all of them (:func:`merge_states`). ``months`` are those that ``silver`` was read for; each gets a mark.
    """
    keys = _state_keys()
    sets = {summary.name: (*MONTH, *(key for key in summary.keys if key not in MONTH)) for summary in SUMMARIES}
    parts = {name: sum_parts(F.col(column), places) for name, (column, places) in _SUMMED.items()}
    grouped = silver.groupingSets([list(columns) for columns in sets.values()], *keys).agg(
        F.grouping_id(*keys).alias("grouping"),
        F.count(F.lit(1)).alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        F.max("fare_amount").alias("most_fare"),
        F.min("fare_amount").alias("least_fare"),
        *[F.struct(*[part.alias(key) for key, part in of_sum.items()]).alias(name) for name, of_sum in parts.items()],
    )
    name = F.lit(None).cast("string")
    for summary, columns in sets.items():
        name = F.when(F.col("grouping") == _grouping_id(keys, columns), F.lit(summary)).otherwise(name)
    states = grouped.withColumn(SET_NAME, name).drop("grouping")
    if not months:
        return states
    kinds = {field.name: field.dataType.simpleString() for field in states.schema.fields}
    marks = silver.sparkSession.createDataFrame([tuple(month) for month in months], ", ".join(f"{key} {kinds[key]}" for key in MONTH))
    return states.unionByName(marks.withColumn(SET_NAME, F.lit(MONTH_MARK)), allowMissingColumns=True)


def merge_states(states: DataFrame, summary: Summary) -> DataFrame:
    """One summary out of the states of all its months; the rows :func:`summarise` gives for their trips."""
    merged = {
        name: {part: F.sum(F.col(f"{name}.{part}")) for part in SUM_PARTS} for name in _SUMMED
    }
    sums = {name: sum_of_parts(parts, _SUMMED[name][1]) for name, parts in merged.items()}
    totals = {name: F.round(value, 2) for name, value in sums.items()}
    means = {name: F.round(F.try_divide(value, merged[name]["present"]), 2) for name, value in sums.items()}
    measures = {
        "total_trips": F.sum("trips"),
        "total_passengers": F.sum("passengers"),
        "avg_fare": means["fare"],
        "total_fare": totals["fare"],
        "avg_tip": means["tip"],
        "total_tip": totals["tip"],
        "avg_distance": means["distance"],
        "total_distance": totals["distance"],
        "avg_duration_minutes": means["minutes"],
        "total_revenue": totals["total"],
        "max_fare": F.round(F.max("most_fare"), 2),
        "min_fare": F.round(F.min("least_fare"), 2),
    }
    own = states.where(F.col(SET_NAME) == summary.name)
    grouped = own.groupBy(*summary.keys).agg(*[measures[name].alias(name) for name in summary.measures])
    return grouped.withColumn("gold_processed_at", F.current_timestamp()).select(*summary.columns())


def pick_summary(combined: DataFrame, summary: Summary) -> DataFrame:
    """One summary's rows and columns out of :func:`summarise_all`."""
    return combined.where(F.col(SET_NAME) == summary.name).select(*summary.columns())
