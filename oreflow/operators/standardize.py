"""Silver standardisation: projections only, so Catalyst folds them into one."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from oreflow.functions import fold_case, quoted, strip, to_boolean, to_double, to_ntz
from oreflow.functions.layouts import Layouts, count_layouts, settle_layouts, to_moment

# The columns each cleaning step applies to, where present.
DATE_COLUMNS = (
    "created_at", "opened_at", "transaction_timestamp", "event_timestamp",
    "rate_date", "loaded_at",
)
NUMERIC_COLUMNS = ("current_balance", "amount", "exchange_rate", "risk_score")
BOOLEAN_COLUMNS = ("is_active", "is_international")
LOWERCASE_COLUMNS = (
    "province", "customer_segment", "risk_tier", "account_status", "currency",
    "product_name", "product_type", "business_domain", "transaction_type",
    "channel", "merchant_category", "ingestion_source", "issue_type", "priority",
    "case_status", "base_currency", "target_currency", "source_system",
    "alert_reason", "recommended_action", "event_source",
)


def _rewrite(
    df: DataFrame, names: Sequence[str], expression: Callable[[str], Column]
) -> DataFrame:
    present = [name for name in names if name in df.columns]
    return df.withColumns({name: expression(name) for name in present})


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip and lower-case the column names; two columns may not end up alike."""
    names = [name.strip().lower() for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"columns collide after normalisation: {clashes}")
    return df.toDF(*names)


def trim_text(df: DataFrame) -> DataFrame:
    """Strip every text column but the technical ones (leading underscore)."""
    return _rewrite(df, [c for c in _text_columns(df) if not c.startswith("_")], strip)


def coerce_dates(
    df: DataFrame, names: Sequence[str] = DATE_COLUMNS, layouts: Layouts | None = None
) -> DataFrame:
    """Zone-less timestamps; with `layouts` also of dates in the layouts people write."""
    if layouts is None:
        return _rewrite(df, names, to_ntz)
    return _rewrite(df, names, lambda name: to_moment(name, layouts))


def date_layouts(df: DataFrame) -> Layouts:
    """Layouts of a dataset's date columns, from one scan of them; a few rows are collected."""
    named = normalize_headers(df)
    present = [name for name in DATE_COLUMNS if name in named.columns]
    return settle_layouts(count_layouts(named, present)) if present else Layouts()


def coerce_numbers(df: DataFrame, names: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    text = set(_text_columns(df))
    return _rewrite(df, names, lambda name: to_double(name, is_text=name in text))


def coerce_booleans(df: DataFrame, names: Sequence[str] = BOOLEAN_COLUMNS) -> DataFrame:
    return _rewrite(df, names, to_boolean)


def lowercase(
    df: DataFrame, names: Sequence[str] = LOWERCASE_COLUMNS, *, stripped: bool = False
) -> DataFrame:
    """Strip and lower-case. ``stripped`` spares the first where it was done before."""
    return _rewrite(df, names, (lambda name: F.lower(quoted(name))) if stripped else fold_case)


def add_transaction_date(df: DataFrame) -> DataFrame:
    if "transaction_timestamp" not in df.columns:
        return df
    return df.withColumn("transaction_date", F.to_date("transaction_timestamp"))


def stamp(df: DataFrame, processed_at: str) -> DataFrame:
    return df.withColumn("_silver_processed_at_utc", F.lit(processed_at))


def _settled(df: DataFrame, as_they_were: Sequence[str]) -> DataFrame:
    """The same rows, whose cleaned values filters and later steps take as they are.

    Pushed below the cleaning, a filter would clean and parse a value again at each
    mention. The condition is always true, but not to the optimizer.
    """
    here = F.spark_partition_id() >= 0
    return df.select(
        *[
            F.col(quoted(c)) if c in as_they_were else F.when(here, F.col(quoted(c))).alias(c)
            for c in df.columns
        ]
    )


def standardize(
    df: DataFrame, processed_at: str, layouts: Layouts | None = None
) -> DataFrame:
    """All steps in order; each skips the columns a dataset does not have.

    ``layouts`` (see `date_layouts`) adds dates that Spark's own cast does not read.
    """
    named = normalize_headers(df)
    return (
        named.transform(trim_text)
        .transform(coerce_dates, layouts=layouts)
        .transform(coerce_numbers)
        .transform(coerce_booleans)
        .transform(lowercase, stripped=True)
        .transform(add_transaction_date)
        .transform(_settled, [c for c in named.columns if c.startswith("_")])
        .transform(stamp, processed_at)
    )
