"""Dates in the layouts people write."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreflow.functions.layouts import AMBIGUOUS, DAY_FIRST, MIXED, MONTH_FIRST, count_layouts, layout_report, merge_counts, settle_layouts, to_moment
from oreflow.operators.standardize import date_layouts, standardize

PLAIN = {
    "2024/01/15": "2024-01-15 00:00:00",
    "2024.1.5": "2024-01-05 00:00:00",
    "15 Jan 2024": "2024-01-15 00:00:00",
    "15-jan-2024": "2024-01-15 00:00:00",
    "5 September 2024 14:05": "2024-09-05 14:05:00",
    "May 5, 2024": "2024-05-05 00:00:00",
    "January 15 2024 1:02:03 am": "2024-01-15 01:02:03",
    "20240115": "2024-01-15 00:00:00",
    "20240115 23:59:58": "2024-01-15 23:59:58",
    "2024-01-15 10:00 PM": "2024-01-15 22:00:00",
    "2024-01-15 12:00 AM": "2024-01-15 00:00:00",
    " 2024/02/29T08:09:10.5 ": "2024-02-29 08:09:10.500000",
    "2024-01-15 10:00:00": "2024-01-15 10:00:00",
    "2024/02/30": None,
    "2024-01-15 13:00 PM": None,
    "15 Foo 2024": None,
    "01/15/24": None,
    "nonsense": None,
    "": None,
    None: None,
    # Readable one way only, whatever the column.
    "01/15/2024": "2024-01-15 00:00:00",
    "15/01/2024": "2024-01-15 00:00:00",
    "04/04/2024": "2024-04-04 00:00:00",
    "03/04/2024": None,
    "15/13/2024": None,
}


def shown(values):
    return [None if v is None else str(v) for v in values]


def test_layouts_that_say_themselves_what_they_mean(column):
    assert dict(zip(PLAIN, shown(column(list(PLAIN), to_moment("v"))), strict=True)) == PLAIN


def test_a_column_settles_day_and_month(spark):
    rows = [("03/04/2024", "03.04.2024", "03-04-2024", "1/2/2024"), ("12/31/2024", "31.12.2024", "04-03-2024", "30/2/2024"), (None, " ", "x", "2/30/2024")]
    df = spark.createDataFrame(rows, "us string, eu string, open string, both string")
    counts = merge_counts(count_layouts(df.limit(1), df.columns).unionByName(count_layouts(df.exceptAll(df.limit(1)), df.columns)))
    report = {(r.column_name, r.layout): (r["values"], r.field_order) for r in layout_report(counts).collect()}
    assert report == {
        ("us", "short/"): (2, MONTH_FIRST), ("eu", "short."): (2, DAY_FIRST), ("open", "short-"): (2, AMBIGUOUS),
        ("open", "other"): (1, None), ("both", "short/"): (3, MIXED),
    }
    layouts = settle_layouts(counts)
    assert layouts.ambiguous() == [("open", "short-")]
    read = df.select(*[to_moment(c, layouts).alias(c) for c in df.columns]).collect()
    assert [shown(r) for r in read] == [
        ["2024-03-04 00:00:00", "2024-04-03 00:00:00", None, None], ["2024-12-31 00:00:00", "2024-12-31 00:00:00", None, None], [None, None, None, None],
    ]
    known = settle_layouts(counts, {"open": DAY_FIRST})
    assert shown(r[0] for r in df.select(to_moment("open", known)).collect()) == ["2024-04-03 00:00:00", "2024-03-04 00:00:00", None]
    with pytest.raises(ValueError, match="order"):
        settle_layouts(counts, {"open": "year_first"})


def test_no_cleaning_expression_inside_a_filter(spark):
    df = spark.createDataFrame([("1", "2024/01/05", " 5 ")], "account_id string, opened_at string, current_balance string")
    rows = standardize(df, "now", date_layouts(df))
    assert rows.first()[1:3] == (dt.datetime(2024, 1, 5), 5.0)
    kept = rows.filter((F.col("current_balance") > 0) & F.col("opened_at").isNotNull())
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("trim" in line or "cast" in line.lower() for line in filters)
