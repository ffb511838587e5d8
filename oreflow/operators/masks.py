"""Rule masks: true = violated, null = undecided."""

from collections.abc import Callable

from pyspark.sql import Column

Mask = Callable[[Column], Column]


def not_positive(value: Column) -> Column:
    return value.isNull() | (value <= 0)


def outside(low: float, high: float) -> Mask:
    """Missing, or not within the inclusive bounds."""
    return lambda value: value.isNull() | ~value.between(low, high)


def not_equal(expected: str) -> Mask:
    """Plain inequality: a missing value is neither right nor wrong."""
    return lambda value: value != expected
