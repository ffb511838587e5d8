"""Sums of doubles to the last bit, whatever the order, the partitions and the range of the values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Binary digits of a bin. A value is cut at absolute places into four whole numbers of about this
# size, so 2**38 rows of a group fit a long integer.
_BITS = 22
# Place of the smallest bit a double has.
_LOWEST = -1074

# Whole number of the digit at place i, from the sums of all bins.
_DIGIT = """aggregate(exact_parts, 0L, (a, p) -> a + CASE p.bin - i
    WHEN 0 THEN p.c0 WHEN 1 THEN p.c1 WHEN 2 THEN p.c2 WHEN 3 THEN p.c3 ELSE 0L END)"""
# Digits from the lowest place up, each in [-2**21, 2**21) after what was left went one place up.
_DIGITS = f"""aggregate(
    sequence(array_min(exact_parts.bin) - 3, array_max(exact_parts.bin) + 4),
    named_struct('over', 0L, 'digits', cast(array() AS array<bigint>)),
    (s, i) -> named_struct(
        'over', shiftright(s.over + {_DIGIT} + {1 << (_BITS - 1)}L, {_BITS}),
        'digits', concat(s.digits, array(
            ((s.over + {_DIGIT} + {1 << (_BITS - 1)}L) & {(1 << _BITS) - 1}L) - {1 << (_BITS - 1)}L))),
    s -> reverse(s.digits))"""


def _times_power(value: Column, power: Column) -> Column:
    """value * 2**power; in two steps, since the factor alone may be out of range."""
    half = F.floor(power / 2)
    two = F.lit(2.0)
    return value * F.pow(two, half.cast("double")) * F.pow(two, (power - half).cast("double"))


def exact_sums(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """``n``, ``total`` and ``mean`` of a double column for each group.

    The total is the true sum rounded once, so retries, another order and
    another number of partitions give the same bits, from the smallest double to the largest.
    Keys may not be named like the results, or start with ``exact_``. Nulls do not count, a group without values has a null total, and infinities and NaN give
    what adding them gives. The key of all rows may be one and the same: rows are summed by (key,
    bin) before they move, and a group then holds at most 96 rows.
    """
    number = F.col("exact_value")
    finite = F.abs(number) < float("inf")
    top = F.floor(F.log2(F.abs(number))) - _LOWEST
    rows = df.select(*keys, value.cast("double").alias("exact_value"))
    rows = rows.select(
        *keys,
        number,
        F.when(finite & (number != 0), F.floor(top / _BITS).cast("int")).otherwise(0).alias("exact_bin"),
    )
    scaled = F.when(finite, _times_power(number, -F.col("exact_bin") * _BITS - _LOWEST))
    rows = rows.select(*keys, "exact_bin", number, scaled.alias("exact_scaled"))

    def upto(k: int) -> Column:
        return F.rint(F.col("exact_scaled") * float(2 ** (_BITS * k)))

    cuts = [upto(0), *[upto(k) - upto(k - 1) * float(2**_BITS) for k in (1, 2, 3)]]
    binned = rows.groupBy(*keys, "exact_bin").agg(
        *[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(f"exact_c{k}") for k, c in enumerate(cuts)],
        F.count("exact_value").alias("exact_n"),
        F.sum(F.when(~finite, number)).alias("exact_other"),
    )
    grouped = binned.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col("exact_bin").alias("bin"), *[F.col(f"exact_c{k}").alias(f"c{k}") for k in range(4)])).alias("exact_parts"),
        F.max("exact_bin").alias("exact_bin"),
        F.sum("exact_n").alias("n"),
        F.sum("exact_other").alias("exact_other"),
    )
    digits = grouped.withColumn("exact_digits", F.expr(_DIGITS))
    first = F.array_position(F.transform("exact_digits", lambda d: d != 0), True)
    placed = digits.withColumn("exact_first", F.greatest(first, F.lit(1)).cast("int"))
    padded = F.concat("exact_digits", F.array(*[F.lit(0).cast("bigint")] * 3))
    # Digits further down only tell on which side of a tie the sum lies.
    below = F.filter(F.slice("exact_digits", F.col("exact_first") + 4, F.lit(128)), lambda d: d != 0)
    side = F.coalesce(F.signum(F.get(below, F.lit(0)).cast("double")), F.lit(0.0)) / 2
    placed = placed.withColumn("exact_side", side)
    placed = placed.withColumn("exact_digits", F.slice(padded, F.col("exact_first"), F.lit(4)))
    digit = [F.get("exact_digits", F.lit(k)).cast("double") for k in range(4)]
    step = float(2**_BITS)
    head, tail = digit[0] * step + digit[1], digit[2] * step + digit[3] + F.col("exact_side")
    # The last of the four digits lies this many places above the lowest bit.
    place = F.col("exact_bin") + 4 - (F.col("exact_first") - 1) - 3
    total = _times_power(head * step * step + tail, place * _BITS + _LOWEST)
    total = F.when(F.col("exact_other").isNotNull(), F.col("exact_other")).otherwise(total)
    summed = placed.select(*keys, "n", F.when(F.col("n") > 0, total).alias("total"))
    return summed.withColumn("mean", F.try_divide(F.col("total"), F.col("n").cast("double")))
