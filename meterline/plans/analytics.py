"""Analytic questions over the gold tables.

Top lists add their key as last sort column, so that equal values come out in the same order every time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.exact import rounded_mean, rounded_sum
from meterline.operators.summaries import DAILY, HOURLY, LOCATION, PAYMENT, SUMMARIES

# Payment codes and time-of-day slots (first hour, last hour, label).
PAYMENT_METHODS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
TIME_SLOTS = (
    (7, 9, "Morning Rush (7-9am)"),
    (17, 19, "Evening Rush (5-7pm)"),
    (0, 5, "Late Night (12-5am)"),
)
OTHER_HOURS = "Other Hours"

Gold = Mapping[str, DataFrame]


def _in_month(year: int, month: int) -> Column:
    return (F.col("pickup_year") == year) & (F.col("pickup_month") == month)


def _payment_method(codes: tuple[int, ...], otherwise: str) -> Column:
    label = F.lit(otherwise)
    for code in codes:
        label = F.when(F.col("payment_type") == code, F.lit(PAYMENT_METHODS[code])).otherwise(label)
    return label


def daily_for_month(gold: Gold, year: int = 2024, month: int = 1) -> DataFrame:
    return (
        gold[DAILY.name]
        .where(_in_month(year, month))
        .select(
            "pickup_date", "total_trips", "total_revenue", "avg_fare", "avg_tip", "avg_distance",
            "avg_duration_minutes",
        )
        .orderBy("pickup_date")
    )


def daily_for_month_head(gold: Gold, year: int = 2024, month: int = 1, days: int = 5) -> DataFrame:
    """The first days of a month."""
    return (
        gold[DAILY.name]
        .where(_in_month(year, month))
        .select("pickup_date", "total_trips", "total_revenue", "avg_fare")
        .orderBy("pickup_date")
        .limit(days)
    )


def top_revenue_days(gold: Gold, days: int = 5) -> DataFrame:
    return (
        gold[DAILY.name]
        .select("pickup_date", "total_trips", "total_revenue")
        .orderBy(F.desc("total_revenue"), "pickup_date")
        .limit(days)
    )


def monthly_revenue(gold: Gold) -> DataFrame:
    """``avg_daily_fare`` is the mean of the daily means: each day counts the same."""
    return (
        gold[DAILY.name]
        .groupBy("pickup_year", "pickup_month")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            rounded_sum(F.col("total_revenue")).alias("total_revenue"),
            rounded_mean(F.col("avg_fare")).alias("avg_daily_fare"),
        )
        .orderBy("pickup_year", "pickup_month")
    )


def busiest_hours(gold: Gold, year: int = 2024, month: int = 1) -> DataFrame:
    return (
        gold[HOURLY.name]
        .where(_in_month(year, month))
        .groupBy("pickup_hour")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            rounded_mean(F.col("avg_fare")).alias("avg_fare"),
            rounded_mean(F.col("avg_duration_minutes")).alias("avg_duration_mins"),
        )
        .orderBy(F.desc("total_trips"), "pickup_hour")
    )


def busiest_hours_year(gold: Gold, year: int = 2024, hours: int = 5) -> DataFrame:
    return (
        gold[HOURLY.name]
        .where(F.col("pickup_year") == year)
        .groupBy("pickup_hour")
        .agg(F.sum("total_trips").alias("total_trips"), rounded_mean(F.col("avg_fare")).alias("avg_fare"))
        .orderBy(F.desc("total_trips"), "pickup_hour")
        .limit(hours)
    )


def rush_hour_slots(gold: Gold) -> DataFrame:
    slot = F.lit(OTHER_HOURS)
    for first, last, label in TIME_SLOTS:
        slot = F.when(F.col("pickup_hour").between(first, last), F.lit(label)).otherwise(slot)
    return (
        gold[HOURLY.name]
        .groupBy(slot.alias("time_slot"))
        .agg(F.sum("total_trips").alias("total_trips"), rounded_mean(F.col("avg_fare")).alias("avg_fare"))
        .orderBy(F.desc("total_trips"), "time_slot")
    )


def _top_locations(gold: Gold, by: str, columns: tuple[str, ...], places: int) -> DataFrame:
    return (
        gold[LOCATION.name]
        .select(F.col("PULocationID").alias("pulocationid"), *columns)
        .orderBy(F.desc(by), "pulocationid")
        .limit(places)
    )


def busiest_locations(gold: Gold, places: int = 10) -> DataFrame:
    columns = ("total_trips", "avg_fare", "avg_distance", "avg_tip", "total_revenue")
    return _top_locations(gold, "total_trips", columns, places)


def busiest_locations_short(gold: Gold, places: int = 10) -> DataFrame:
    return _top_locations(gold, "total_trips", ("total_trips", "avg_fare", "total_revenue"), places)


def top_revenue_locations(gold: Gold, places: int = 10) -> DataFrame:
    return _top_locations(gold, "total_revenue", ("total_trips", "total_revenue", "avg_fare"), places)


def long_distance_hotspots(gold: Gold, miles: float = 5.0, places: int = 10) -> DataFrame:
    far = {LOCATION.name: gold[LOCATION.name].where(F.col("avg_distance") > miles)}
    columns = ("total_trips", "avg_distance", "avg_fare", "avg_duration_minutes")
    return _top_locations(far, "avg_distance", columns, places)


def payment_breakdown(gold: Gold) -> DataFrame:
    """Share of all trips per payment type.

    The grand total is a scalar subquery, so that no task holds the whole table, however many payment codes there are.
    Its value is a struct that also looks at the other columns: so it needs the very rows that the answer needs, and
    both read one exchange of them. Asked for the total alone it would be a plan, and a scan of all trips, of its own.
    """
    columns = ("payment_type", "total_trips", "avg_fare", "avg_tip", "total_revenue")
    payment = gold[PAYMENT.name].select(*columns)
    whole = payment.select(F.struct(F.sum("total_trips").alias("trips"), *[F.count(name).alias(f"with_{name}") for name in columns])).scalar()
    share = F.round(F.col("total_trips").cast("double") * F.lit(100.0) / whole.getField("trips"), 2)
    return (
        payment.select(
            _payment_method((1, 2, 3, 4), "Unknown").alias("payment_method"), *columns[1:], share.alias("trip_percentage"), "payment_type"
        )
        .orderBy(F.desc("total_trips"), "payment_type")
        .drop("payment_type")
    )


def payment_breakdown_plain(gold: Gold) -> DataFrame:
    return (
        gold[PAYMENT.name]
        .select(
            _payment_method((1, 2, 3, 4), "Unknown").alias("payment_method"),
            "total_trips", "avg_fare", "avg_tip", "total_revenue",
            "payment_type",
        )
        .orderBy(F.desc("total_trips"), "payment_type")
        .drop("payment_type")
    )


def card_vs_cash_tips(gold: Gold) -> DataFrame:
    """Tip as a percentage of the fare; null where the average fare is zero."""
    rate = F.col("avg_tip") / F.nullif(F.col("avg_fare"), F.lit(0.0)) * 100
    return (
        gold[PAYMENT.name]
        .where(F.col("payment_type").isin(1, 2))
        .orderBy("payment_type")
        .select(
            _payment_method((1, 2), "Other").alias("payment_method"),
            "avg_tip", "avg_fare",
            F.round(rate, 2).alias("tip_percentage"),
        )
    )


def gold_row_counts(gold: Gold) -> DataFrame:
    """Rows of each gold table. Stored tables are counted from their footers, planned ones together."""
    if hasattr(gold, "row_counts"):
        return gold.row_counts()
    counts = [
        gold[summary.name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(summary.name).alias("gold_table"), "row_count")
        for summary in SUMMARIES
    ]
    first, *others = counts
    for other in others:
        first = first.unionAll(other)
    return first


QUESTIONS: dict[str, Callable[[Gold], DataFrame]] = {
    question.__name__: question
    for question in (
        daily_for_month, top_revenue_days, monthly_revenue, busiest_hours, rush_hour_slots, busiest_locations,
        top_revenue_locations, long_distance_hotspots, payment_breakdown, card_vs_cash_tips, gold_row_counts,
        daily_for_month_head, busiest_hours_year, busiest_locations_short, payment_breakdown_plain,
    )
}


def registered_gold(spark: SparkSession, database: str) -> Gold:
    """The gold tables as registered in the catalog."""
    return {summary.name: spark.table(f"`{database}`.`{summary.name}`") for summary in SUMMARIES}
