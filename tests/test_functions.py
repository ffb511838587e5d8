import math
import random

import pytest
from pyspark.sql import functions as F

from oreflow.functions import (
    fold_case,
    guarded_ratio,
    is_blank,
    null_if_na,
    round_half_away,
    row_hash,
    stable_avg,
    stable_sum,
    strip,
    to_boolean,
    to_double,
    to_ntz,
)
from oreflow.functions.text import NA_TOKENS


def test_strip_removes_every_kind_of_whitespace(column):
    values = ["\t a ", "", "   ", None, "NA", "  x　\r\n", "a b", "\x1f'q\\'\x0b"]
    assert column(values, strip("v")) == [
        v if v is None else v.strip() for v in values
    ]


def test_fold_case(column):
    assert column([" Été ", "\tABC\n", None], fold_case("v")) == ["été", "abc", None]


def test_is_blank_is_never_null(column):
    assert column([None, "", " \t", "x"], is_blank("v")) == [True, True, True, False]


def test_na_tokens_become_null_and_nothing_else(column):
    kept = ["Na", " NA", "none", "0", "nul"]
    assert column([*NA_TOKENS, *kept], null_if_na("v")) == [None] * len(NA_TOKENS) + kept


def test_to_double(column):
    values = ["1e3", " 5 ", "inf", "-Infinity", "NaN", "x", None, "0", "-1", "1d", "2.5F", "0x1p3",
              "1.2E-4"]
    assert column(values, to_double("v")) == [
        1000.0, 5.0, math.inf, -math.inf, None, None, None, 0.0, -1.0, None, None, None, 0.00012,
    ]


def test_to_double_maps_nan_numbers_to_null(column):
    values = [1.5, float("nan"), None]
    assert column(values, to_double("v", is_text=False), "double") == [1.5, None, None]


def test_to_ntz_and_boolean(column):
    values = ["2024-01-02", "2024-01-02 03:04:05", "bad", None]
    got = column(values, to_ntz("v"))
    assert [str(v) for v in got] == ["2024-01-02 00:00:00", "2024-01-02 03:04:05", "None", "None"]
    assert column(["True", "False", "maybe", None], to_boolean("v")) == [True, False, None, None]


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [
        (1.005, 2, 1.0),
        (2.675, 2, 2.68),
        (-0.125, 2, -0.13),
        (0.285, 2, 0.28),
        (0.8496, 3, 0.85),
        (None, 2, None),
    ],
)
def test_round_half_away_works_on_the_scaled_double(column, value, digits, expected):
    assert column([value], round_half_away(F.col("v"), digits), "double") == [expected]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 4)], "a bigint, b bigint")
    got = [r[0] for r in df.select(guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.25, 0.0, None]


def _hashes(spark, rows, names):
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    return [r[0] for r in df.select(row_hash(names)).collect()]


def test_row_hash_tells_nulls_and_delimiters_apart(spark):
    rows = [(None, "a"), ("a", None), ("a|b", "c"), ("a", "b|c"), ("-", "a"), ("", "a")]
    assert len(set(_hashes(spark, rows, ["x", "y"]))) == len(rows)
    first, second = _hashes(spark, [("a", "b"), ("a", "b")], ["x", "y"])
    assert first == second


def test_sums_do_not_depend_on_order(spark):
    random.seed(1)
    values = [round(random.uniform(-5e5, 5e5), 2) for _ in range(5000)]
    cents = sum(round(v * 100) for v in values)
    results = set()
    for parts in (1, 3, 7, 16):
        random.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        results.add(tuple(df.agg(stable_sum(F.col("v")), stable_avg(F.col("v"))).first()))
    assert results == {(cents / 100, cents / 100 / len(values))}


def test_sums_of_nothing_and_of_infinity(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return tuple(df.agg(stable_sum(F.col("v")), stable_avg(F.col("v"))).first())

    assert total([None, None]) == (None, None)
    assert total([]) == (None, None)
    assert total([1.0, None, 2.0]) == (3.0, 1.5)
    assert total([1.0, math.inf]) == (math.inf, math.inf)
