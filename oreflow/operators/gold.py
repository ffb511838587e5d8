"""Gold marts.

Facts are aggregated before they are joined, so joins see one row per key and
a customer, account or product that holds a large share of the facts costs one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions import round_half_away, stable_avg, stable_sum


def _count() -> Column:
    return F.count(F.lit(1))


def _sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def _zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _count_keys(name: str, unique: bool) -> Column:
    return F.count(name) if unique else F.countDistinct(name)


def account_totals(accounts: DataFrame, *, unique_accounts: bool = False) -> DataFrame:
    """Accounts per customer.

    ``unique_accounts`` is for input whose account ids are known to be unique,
    as validation leaves them: counting them needs no DISTINCT then, which
    saves the threefold row expansion of two distinct counts.
    """
    return accounts.groupBy("customer_id").agg(
        _count_keys("account_id", unique_accounts).alias("account_count"),
        F.countDistinct("product_id").alias("product_count"),
        _sum_if(F.col("account_status") == "active").alias("active_account_count"),
        stable_sum(F.col("current_balance")).alias("total_current_balance"),
        stable_avg(F.col("current_balance")).alias("average_current_balance"),
    )


def transaction_totals(transactions: DataFrame) -> DataFrame:
    """Transactions per customer."""
    return transactions.groupBy("customer_id").agg(
        _count().alias("transaction_count"),
        stable_sum(F.col("amount")).alias("total_transaction_amount"),
        stable_avg(F.col("amount")).alias("average_transaction_amount"),
        F.max("transaction_timestamp").alias("most_recent_transaction_at"),
        _sum_if(F.col("is_international")).alias("international_transaction_count"),
        F.countDistinct("channel").alias("channel_count"),
    )


def fraud_totals(alerts: DataFrame) -> DataFrame:
    """Fraud alerts per customer; alerts without a customer form a group."""
    return alerts.groupBy("customer_id").agg(
        _count().alias("fraud_alert_count"),
        stable_avg(F.col("risk_score")).alias("average_fraud_risk_score"),
        F.max("risk_score").alias("maximum_fraud_risk_score"),
        _sum_if(F.col("recommended_action") == "review").alias("fraud_review_count"),
    )


def service_totals(notes: DataFrame) -> DataFrame:
    """Service cases per customer."""
    return notes.groupBy("customer_id").agg(
        _count().alias("service_case_count"),
        _sum_if(F.col("priority") == "high").alias("high_priority_case_count"),
        _sum_if(F.col("case_status").isin("open", "in_progress")).alias("open_case_count"),
        F.max("created_at").alias("most_recent_service_case_at"),
    )


def customer_360(
    customers: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    alerts: DataFrame,
    notes: DataFrame,
    *,
    unique_accounts: bool = False,
) -> DataFrame:
    """One row per customer with the totals of all four fact sets.

    Each fact set arrives at the joins hash-partitioned by customer from its
    own aggregation, so the joins add an exchange for the customers only.
    """
    joined = customers
    for totals in (
        account_totals(accounts, unique_accounts=unique_accounts),
        transaction_totals(transactions),
        fraud_totals(alerts),
        service_totals(notes),
    ):
        joined = joined.join(totals, "customer_id", "left")

    def rounded(name: str, digits: int) -> Column:
        return round_half_away(_zero_if_null(name), digits).alias(name)

    def counted(name: str) -> Column:
        return _zero_if_null(name).alias(name)

    return joined.select(
        "customer_id",
        "province",
        "customer_segment",
        "risk_tier",
        customers["created_at"].alias("customer_created_at"),
        "is_active",
        counted("account_count"),
        counted("product_count"),
        counted("active_account_count"),
        rounded("total_current_balance", 2),
        rounded("average_current_balance", 2),
        counted("transaction_count"),
        rounded("total_transaction_amount", 2),
        rounded("average_transaction_amount", 2),
        "most_recent_transaction_at",
        counted("international_transaction_count"),
        counted("channel_count"),
        counted("fraud_alert_count"),
        rounded("average_fraud_risk_score", 3),
        rounded("maximum_fraud_risk_score", 3),
        counted("fraud_review_count"),
        counted("service_case_count"),
        counted("high_priority_case_count"),
        counted("open_case_count"),
        "most_recent_service_case_at",
    )


def daily_transaction_summary(transactions: DataFrame) -> DataFrame:
    """Transactions per day, type, channel and merchant category; null keys form groups."""
    return transactions.groupBy(
        F.col("transaction_date").cast("date").alias("transaction_date"),
        "transaction_type",
        "channel",
        "merchant_category",
    ).agg(
        _count().alias("transaction_count"),
        round_half_away(stable_sum(F.col("amount")), 2).alias("total_transaction_amount"),
        round_half_away(stable_avg(F.col("amount")), 2).alias("average_transaction_amount"),
        round_half_away(F.max("amount"), 2).alias("maximum_transaction_amount"),
        _sum_if(F.col("is_international")).alias("international_transaction_count"),
    )


def account_transactions(transactions: DataFrame) -> DataFrame:
    """Transactions per account."""
    return transactions.groupBy("account_id").agg(
        _count().alias("transaction_count"),
        stable_sum(F.col("amount")).alias("total_transaction_amount"),
        stable_avg(F.col("amount")).alias("average_transaction_amount"),
    )


def product_performance(
    products: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    *,
    unique_accounts: bool = False,
) -> DataFrame:
    """Accounts, balances and transactions per product.

    Accounts are summed up per product before the products join, so a popular
    product's accounts never meet in one task. Distinct values are counted over the accounts alone: beside
    the sums, each of them would carry a row of all sums through the shuffle. Balances stay null for products without
    accounts; the average amount is the plain mean of the accounts' averages.
    A product listed twice counts its totals twice, as joining first would.
    """
    keys = ["product_id", "product_name", "product_type", "business_domain"]
    counts = accounts.groupBy("product_id").agg(
        _count_keys("account_id", unique_accounts).alias("account_count"),
        F.countDistinct("customer_id").alias("customer_count"),
    )
    totals = (
        accounts.select("account_id", "product_id", "current_balance")
        .join(account_transactions(transactions), "account_id", "left")
        .groupBy("product_id")
        .agg(
            stable_sum(F.col("current_balance")).alias("total_current_balance"),
            stable_avg(F.col("current_balance")).alias("average_current_balance"),
            F.sum("transaction_count").alias("transaction_count"),
            stable_sum(F.col("total_transaction_amount")).alias("total_transaction_amount"),
            stable_avg(F.col("average_transaction_amount")).alias("average_transaction_amount"),
        )
    )
    copies = F.col("product_copies")
    return (
        products.groupBy(*keys)
        .agg(_count().alias("product_copies"))
        .join(counts, "product_id", "left")
        .join(totals, "product_id", "left")
        .select(
            *keys,
            _zero_if_null("account_count").alias("account_count"),
            _zero_if_null("customer_count").alias("customer_count"),
            round_half_away(F.col("total_current_balance") * copies, 2).alias(
                "total_current_balance"
            ),
            round_half_away(F.col("average_current_balance"), 2).alias("average_current_balance"),
            (_zero_if_null("transaction_count") * copies).alias("transaction_count"),
            round_half_away(_zero_if_null("total_transaction_amount") * copies, 2).alias(
                "total_transaction_amount"
            ),
            round_half_away(_zero_if_null("average_transaction_amount"), 2).alias(
                "average_transaction_amount"
            ),
        )
    )


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Rule hits per dataset and severity, from reject records or from counts in ``rule_hits``."""
    weight = F.col("rule_hits") if "rule_hits" in rejects.columns else F.lit(1)

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, weight).otherwise(0)).cast("bigint")

    graded = {
        f"{grade}_reject_rule_hits": total(F.col("severity") == grade)
        for grade in ("critical", "high", "medium")
    }
    return rejects.groupBy("dataset_name").agg(
        F.sum(weight).cast("bigint").alias("total_reject_rule_hits"),
        *[column.alias(name) for name, column in graded.items()],
    )


def data_quality_dashboard(audit: DataFrame, rejects: DataFrame) -> DataFrame:
    """Audit counts, acceptance rate and rule hits, one row per dataset."""
    hits = [
        "total_reject_rule_hits",
        "critical_reject_rule_hits",
        "high_reject_rule_hits",
        "medium_reject_rule_hits",
    ]
    return audit.join(reject_summary(rejects), "dataset_name", "left").select(
        "dataset_name",
        "bronze_table",
        "silver_table",
        "bronze_row_count",
        "silver_row_count",
        "rejected_rule_hits",
        F.try_divide(
            F.col("silver_row_count").cast("double"), F.col("bronze_row_count").cast("double")
        ).alias("acceptance_rate"),
        *[_zero_if_null(name).alias(name) for name in hits],
        "processed_at_utc",
        "status",
    )
