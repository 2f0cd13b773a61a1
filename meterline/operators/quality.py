"""Row quality: ordered rules, one reason per rejected row, split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.config import QualityBounds

# Column names, the two states, and (in ``trip_rules``) the reasons.
REASON = "dq_reject_reason"
STATUS = "dq_status"
VALID = "VALID"
REJECTED = "REJECTED"


@dataclass(frozen=True)
class Rule:
    """A named reason and the predicate that is true for rows to reject.

    ``keeps`` is optional: comparisons that every accepted row meets and that Parquet statistics can
    answer. It lets a scan for valid rows skip row groups, which a chain of cases cannot.
    """

    reason: str
    rejects: Column
    keeps: Column | None = None


def trip_rules(bounds: QualityBounds = QualityBounds()) -> tuple[Rule, ...]:
    """The trip rules in the order they apply; the first that matches names the row's reason."""
    passengers, distance = F.col("passenger_count"), F.col("trip_distance")
    fare, total = F.col("fare_amount"), F.col("total_amount")
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    # A NaN total is accepted, and file statistics may leave NaN out, so totals are not pruned by range.
    return (
        Rule(
            "invalid_passenger_count",
            passengers.isNull() | ~passengers.between(bounds.min_passengers, bounds.max_passengers),
            keeps=(passengers >= bounds.min_passengers) & (passengers <= bounds.max_passengers),
        ),
        Rule(
            "invalid_trip_distance",
            distance.isNull() | (distance <= bounds.min_distance) | (distance >= bounds.max_distance),
            keeps=(distance > bounds.min_distance) & (distance < bounds.max_distance),
        ),
        Rule(
            "invalid_fare_amount",
            fare.isNull() | (fare <= bounds.min_fare) | (fare >= bounds.max_fare),
            keeps=(fare > bounds.min_fare) & (fare < bounds.max_fare),
        ),
        Rule("invalid_total_amount", total.isNull() | (total <= bounds.min_total), keeps=total.isNotNull()),
        Rule("null_pickup_datetime", pickup.isNull(), keeps=pickup.isNotNull()),
        Rule("null_dropoff_datetime", dropoff.isNull(), keeps=dropoff.isNotNull()),
        Rule("dropoff_before_pickup", dropoff <= pickup),
        Rule("pickup_year_too_old", F.year(pickup) < bounds.first_year),
        Rule("pickup_year_future", F.year(pickup) > bounds.last_year),
    )


def reject_reason(rules: Sequence[Rule]) -> Column:
    """First matching rule's reason, null for a row no rule rejects."""
    head, *tail = rules
    chain = F.when(head.rejects, F.lit(head.reason))
    return reduce(lambda case, rule: case.when(rule.rejects, F.lit(rule.reason)), tail, chain)


def tag_quality(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Adds the reject reason and the status it implies."""
    reason = reject_reason(rules if rules is not None else trip_rules())
    return df.withColumn(REASON, reason).withColumn(
        STATUS, F.when(F.col(REASON).isNull(), F.lit(VALID)).otherwise(F.lit(REJECTED))
    )


def prune_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Leaves out rows that some rule's ``keeps`` shows to be rejected; all valid rows remain."""
    return df.where(reduce(Column.__and__, [rule.keeps for rule in rules if rule.keeps is not None], F.lit(True)))


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(STATUS) == VALID)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(STATUS) == REJECTED)


def rejected_by(tagged: DataFrame, reason: str) -> DataFrame:
    return tagged.where(F.col(REASON) == reason)


def quality_metrics(tagged: DataFrame) -> DataFrame:
    """Total, valid and rejected rows and the rejection rate in percent, all in one pass."""
    total, rejected = F.count(F.lit(1)), F.count_if(F.col(STATUS) == REJECTED)
    return tagged.agg(
        total.alias("total_rows"),
        F.count_if(F.col(STATUS) == VALID).alias("valid_rows"),
        rejected.alias("rejected_rows"),
        F.coalesce(F.round(F.try_divide(rejected * F.lit(100.0), total), 2), F.lit(0.0)).alias("rejection_rate_pct"),
    )


def rejects_by_reason(tagged: DataFrame) -> DataFrame:
    return rejected_rows(tagged).groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
