"""Numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreflow.functions.text import quoted


def to_double(name: str, *, is_text: bool = True) -> Column:
    """Number, or null where the value is none. NaN counts as missing.

    The JVM also parses suffixed (``1d``) and hexadecimal literals; those are
    text, not numbers, to the data owners and become null. Of the
    numbers only ``inf`` ends in one of those letters.
    """
    column = quoted(name)
    if not is_text:
        return F.expr(f"nullif(CAST({column} AS DOUBLE), double('NaN'))")
    jvm_only = (
        f"{column} LIKE '%d' OR {column} LIKE '%D' OR {column} LIKE '%x%' OR {column} LIKE '%X%' "
        f"OR (({column} LIKE '%f' OR {column} LIKE '%F') AND lower({column}) NOT LIKE '%inf')"
    )
    number = f"try_cast({column} AS DOUBLE)"
    return F.expr(f"nullif(CASE WHEN NOT ({jvm_only}) THEN {number} END, double('NaN'))")


def round_half_away(value: Column, digits: int) -> Column:
    """Round the scaled double half away from zero.

    ``F.round(x, n)`` rounds the decimal text of x instead, so that 1.005
    becomes 1.01 although the stored number is below 1.005.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale)) / F.lit(scale)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0.0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        F.try_divide(numerator.cast("double"), denominator.cast("double"))
    )
