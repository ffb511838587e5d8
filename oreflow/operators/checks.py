"""Output checks and quality limits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """How many rows lack the key."""
    return df.filter(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("null_keys"))


def row_count_check(df: DataFrame, table: str, expected: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(expected).cast("bigint").alias("expected_rows"),
        (F.col("row_count") == expected).alias("passed"),
    )


def lookup(df: DataFrame, dataset: str, *columns: str) -> DataFrame:
    """The named columns of one dataset's row in a quality table."""
    return df.filter(F.col("dataset_name") == dataset).select("dataset_name", *columns)


@dataclass(frozen=True)
class QualityLimits:
    """Limits on bronze data. ``fail_on_breach`` turns a breach into an error."""

    minimum_customer_id_completeness: float = 0.99
    minimum_transaction_id_completeness: float = 0.995
    maximum_duplicate_transaction_rate: float = 0.001
    maximum_negative_balance_rate: float = 0.005
    fail_on_breach: bool = False


class QualityBreach(RuntimeError):
    """Raised when data exceeds its limits and the limits say so."""


def quality_gates(
    customers: DataFrame,
    transactions: DataFrame,
    accounts: DataFrame,
    limits: QualityLimits = QualityLimits(),
) -> DataFrame:
    """Measured value, limit and verdict of every gate.

    Expects standardised bronze rows. Empty input measures null and passes.
    """
    # Completeness and duplicates of transactions both follow from the rows per key.
    copies = transactions.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("copies"))
    share = [
        F.try_divide(
            F.sum(F.when(condition, F.col("copies")).otherwise(0)).cast("double"),
            F.sum("copies").cast("double"),
        )
        for condition in (F.col("transaction_id").isNotNull(), F.col("copies") > 1)
    ]
    balance = F.col("current_balance")
    # Rows without a balance do not count. No filter: the value is read once.
    negative = F.avg(F.when(balance < 0, 1.0).when(balance.isNotNull(), 0.0))
    measured = {
        "customer_id_completeness": F.avg(
            F.when(F.col("customer_id").isNotNull(), 1.0).otherwise(0.0)
        ),
        "transaction_id_completeness": share[0],
        "duplicate_transaction_rate": share[1],
        "negative_balance_rate": negative,
    }
    tables = {
        "customer_id_completeness": customers,
        "transaction_id_completeness": copies,
        "negative_balance_rate": accounts,
    }
    limit = {
        "customer_id_completeness": (limits.minimum_customer_id_completeness, True),
        "transaction_id_completeness": (limits.minimum_transaction_id_completeness, True),
        "duplicate_transaction_rate": (limits.maximum_duplicate_transaction_rate, False),
        "negative_balance_rate": (limits.maximum_negative_balance_rate, False),
    }

    def judged(name: str) -> Column:
        value, (bound, is_minimum) = F.col(name), limit[name]
        met = value >= bound if is_minimum else value <= bound
        return F.struct(
            F.lit(name).alias("gate"),
            value.alias("measured"),
            F.lit(bound).alias("gate_limit"),
            F.coalesce(met, F.lit(True)).alias("passed"),
        )

    frames = []
    for first, table in tables.items():
        names = [first, "duplicate_transaction_rate"] if table is copies else [first]
        one_row = table.agg(*[measured[name].alias(name) for name in names])
        frames.append(one_row.select(F.inline(F.array(*map(judged, names)))))
    return reduce(DataFrame.unionByName, frames)


def verdict(gates: DataFrame) -> DataFrame:
    """One row: how many gates there are, which are broken, and whether the run passes."""
    broken = F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("gate"))))
    return gates.agg(F.count(F.lit(1)).alias("gates"), broken.alias("broken")).select(
        "gates",
        F.size("broken").cast("bigint").alias("broken_gates"),
        F.array_join("broken", ", ").alias("broken_names"),
        F.when(F.size("broken") > 0, "breach").otherwise("passed").alias("run_verdict"),
    )


def enforce(gates: DataFrame, limits: QualityLimits) -> None:
    """Raise on a breach when the limits ask for it. The frame has one row per gate."""
    if not limits.fail_on_breach:
        return
    broken = [row["gate"] for row in gates.filter(~F.col("passed")).select("gate").collect()]
    if broken:
        raise QualityBreach(f"quality limits exceeded: {', '.join(sorted(broken))}")
