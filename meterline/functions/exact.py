"""Rounding, sums and means of decimal-valued doubles.

Sums and means do not depend on row order. A double sum changes in its last digits with the order rows arrive in, which
after rounding to cents shows up as a difference of one cent between two runs. Each value goes, as its decimal text has
it, into one of two sums: whole units (cents, say) as ``bigint``, which is exact and stays in generated code, or, where
units do not give the value back, a wide decimal. Both combine before the shuffle, and neither depends on the group.

Only a group with a value that no wide decimal gives back (NaN, infinite, 1e14 and more, or digits beyond the 24th
decimal) is added up as plain doubles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units up to here are added as bigint, in two parts, so that no number of rows makes a part overflow.
_UNIT_LIMIT = float(2**43)
_LOW_BITS = 20
# A wide value has at most so many digits before and behind the point.
_WIDE = "decimal(38,24)"


# Up to here a value times 100 is off by far less than the margin kept around ties.
_FAST_LIMIT = 1e8
_TIE_MARGIN = 1e-3


def round_cents(value: Column) -> Column:
    """The same as ``round(value, 2)``, several times faster on values that are no ties.

    ``round`` on a double goes through its decimal text, so that 1.005 becomes 1.01. Away from a tie the
    nearest whole number of cents is the answer either way; near one, ``round`` decides.
    """
    scaled = value * F.lit(100.0)
    from_tie = F.abs(scaled - F.floor(scaled) - F.lit(0.5))
    plain = (F.abs(value) < F.lit(_FAST_LIMIT)) & (from_tie > F.lit(_TIE_MARGIN))
    # Adding zero turns -0.0 into 0.0, as ``round`` does.
    return F.when(plain, F.rint(scaled) / F.lit(100.0) + F.lit(0.0)).otherwise(F.round(value, 2))


def whole_units(value: Column, places: int) -> Column:
    """``value`` in units of ``10**-places`` as bigint, null where that does not give the value back."""
    scale = F.lit(float(10**places))
    units = F.rint(value * scale)
    return F.when((F.abs(units) < F.lit(_UNIT_LIMIT)) & (units / scale == value), units.cast("bigint"))


def _wide(value: Column) -> Column:
    """``value`` as a wide decimal, null where that does not give it back."""
    wide = value.try_cast(_WIDE)
    return F.when(wide.cast("double") == value, wide)


# What a sum is made of. Each part is itself a sum, so parts of several groups merge by adding them up.
SUM_PARTS = ("high", "low", "whole", "rest", "held", "present", "plain")


def sum_parts(value: Column, places: int = 2) -> dict[str, Column]:
    """Aggregates by name of part: what :func:`sum_of_parts` needs, and what may be stored and merged."""
    units = whole_units(value, places)
    # Nulls and values that units hold stay out of the wide sum, so the cast is the exception, not the rule.
    wide = F.when(value.isNotNull() & units.isNull(), _wide(value))
    whole = F.floor(wide)
    return {
        "high": F.sum(F.shiftright(units, _LOW_BITS)),
        "low": F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))),
        "whole": F.sum(whole.cast("decimal(28,0)")),
        "rest": F.sum((wide - whole).cast("decimal(27,24)")),
        "held": F.count(units) + F.count(wide),
        "present": F.count(value),
        "plain": F.sum(value),
    }


def sum_of_parts(parts: Mapping[str, Column], places: int = 2) -> Column:
    """The sum as a double; null without a value."""
    total_units = parts["high"].cast("decimal(38,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + parts["low"].cast("decimal(20,0)")
    in_units = F.coalesce(total_units, F.lit(0)).cast("double") / F.lit(float(10**places))
    in_wide = F.coalesce(parts["whole"].cast("double"), F.lit(0.0)) + F.coalesce(parts["rest"].cast("double"), F.lit(0.0))
    held = parts["present"] == parts["held"]
    return F.when(parts["present"] == 0, F.lit(None).cast("double")).when(held, in_units + in_wide).otherwise(parts["plain"])


def exact_sum(value: Column, places: int = 2) -> Column:
    """Aggregate: sum of a double; ``places`` is how many decimals most values have."""
    return sum_of_parts(sum_parts(value, places), places)


def rounded_sum(value: Column, places: int = 2) -> Column:
    """Aggregate: the sum, rounded to cents."""
    return F.round(exact_sum(value, places), 2)


def rounded_mean(value: Column, places: int = 2) -> Column:
    """Aggregate: the mean of the non-null values, rounded to cents; null when there are none."""
    return F.round(F.try_divide(exact_sum(value, places), F.count(value)), 2)
