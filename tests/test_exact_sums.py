"""Sums to the last bit against whole-number arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from oreflow.functions import exact_sums, stable_sum


def wide_values(n, seed=3):
    source = random.Random(seed)
    values = [source.choice((-1, 1)) * source.uniform(1, 10) * 10.0 ** source.randint(-300, 299) for _ in range(n)]
    values += [5e-324, -5e-324, 2.2250738585072014e-308, 0.0, -0.0, None]
    return values + [-v for v in values[: n // 2]]  # what is left has to come out of cancellation


def totals(spark, rows, parts=1):
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    return {r.k: (r.n, r.total, r["mean"]) for r in exact_sums(df, ["k"], F.col("v")).collect()}


def true_sum(values):
    return float(sum((Fraction(v) for v in values if v is not None), Fraction(0)))


def test_same_bits_for_any_partitions(spark):
    rows = [("wide", v) for v in wide_values(600)]
    rows += [("small", v and v * 1e-9) for v in wide_values(50, 8) if v is None or abs(v) < 1e-200]
    rows += [("money", n / 100) for n in range(-300, 2000, 7)]
    found = [totals(spark, rows, parts) for parts in (1, 7, 200)]
    assert found[0] == found[1] == found[2]
    for key in ("wide", "small", "money"):
        values = [v for k, v in rows if k == key]
        n, total, mean = found[0][key]
        assert n == sum(v is not None for v in values)
        assert total == true_sum(values) and mean == total / n


@pytest.mark.parametrize("values", [
    [1e300, 1.0, -1e300], [1e16, 1.0, 1.0, -1e16], [0.1] * 10, [2.0**53, 1.0, 2.0**-1000], [5e-324] * 3,
    [1e-300, -1e-300], [1.7e308, 1.7e308, -1.7e308], [2.0**22, 2.0**22, -1.0], [2.0**-22 - 2.0**-75], [-1.0, 2.0**-53],
])
def test_true_sum_after_cancellation(spark, values):
    assert totals(spark, [("a", v) for v in values], 3)["a"][1] == true_sum(values)


def test_special_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("inf", inf), ("inf", 1.0), ("both", inf), ("both", -inf), ("nan", nan), ("nan", 1e300), ("none", None), (None, 2.0), (None, 0.5)]
    found = totals(spark, rows)
    assert found["inf"][:2] == (2, inf) and found["none"] == (0, None, None) and found[None] == (2, 2.5, 1.25)
    assert math.isnan(found["both"][1]) and math.isnan(found["nan"][1])
    assert totals(spark, []) == {}


def test_both_halves_of_fractions(spark):
    # Both halves of a fraction, of either sign, against the exact product.
    n = 3_000_000
    row = spark.range(n).select(F.when(F.col("id") % 2 == 0, 0.499999999).otherwise(-0.25).alias("v")).agg(stable_sum(F.col("v"))).first()
    assert row[0] == pytest.approx(n / 2 * (0.499999999 - 0.25), abs=1e-9)


def test_one_hot_key_is_summed_before_it_moves(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    plan = exact_sums(df, ["k"], F.col("v"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 5 and "Window" not in plan and "Python" not in plan
