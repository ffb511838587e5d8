"""Sums and means of doubles that do not depend on the order of addition."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of a value below which a double cannot tell it from its neighbours.
_RESOLUTION = 2.0**-52
# Nine digits after the point are added up as whole numbers, finer parts as they are.
_FRACTION = 1e9
# Binary digits of the lower of the two whole numbers a fraction is added up as.
_HALF = 15


def stable_sum(value: Column) -> Column:
    """Sum of a double column, null when there is nothing to sum.

    Whole parts are added up as integers held in doubles, exact up to 2**53,
    and nine digits after the point as two long integers, which hold 2**47 rows, so task order, retries
    and partition counts cannot move a total across a rounding boundary. What
    is finer is a third, plain sum, unless it is under the resolution of the
    value itself (0.1 has no finer part, though no double equals it). Infinities
    and NaN go into the whole part alone. Where every bit must be the same for any values, use
    ``exact_sums``, which takes a second step of aggregation.
    """
    whole = F.rint(value)
    rest = F.nanvl(value - whole, F.lit(0.0))
    fraction = F.rint(rest * _FRACTION).cast("bigint")
    left = rest - fraction / F.lit(_FRACTION)
    finer = F.when(F.abs(left) > F.abs(value) * _RESOLUTION, left).otherwise(
        F.when(value.isNotNull(), 0.0)
    )
    upper = F.sum(F.shiftright(fraction, _HALF)).cast("decimal(38,0)")
    lower = F.sum(fraction.bitwiseAND(F.lit((1 << _HALF) - 1)))
    fractions = (upper * F.lit(1 << _HALF).cast("decimal(10,0)") + lower).cast("double")
    return F.sum(whole) + fractions / _FRACTION + F.sum(finer)


def stable_avg(value: Column) -> Column:
    """Mean of a double column; nulls do not count."""
    return F.try_divide(stable_sum(value), F.count(value).cast("double"))
