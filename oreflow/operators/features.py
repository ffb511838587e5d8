"""Customer risk features for model training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions import guarded_ratio

# The customer 360 columns the feature table keeps, in order.
FEATURE_COLUMNS = (
    "customer_id", "province", "customer_segment", "risk_tier", "is_active",
    "account_count", "product_count", "active_account_count",
    "total_current_balance", "average_current_balance",
    "transaction_count", "total_transaction_amount", "average_transaction_amount",
    "international_transaction_count", "channel_count",
    "fraud_alert_count", "average_fraud_risk_score", "maximum_fraud_risk_score",
    "fraud_review_count",
    "service_case_count", "high_priority_case_count", "open_case_count",
)


def feature_projection(customer_360: DataFrame) -> DataFrame:
    return customer_360.select(*FEATURE_COLUMNS)


def ratios() -> dict[str, Column]:
    """The three ratio features, 0 where there is nothing to divide by."""
    return {
        "international_transaction_ratio": guarded_ratio(
            F.col("international_transaction_count"), F.col("transaction_count")
        ),
        "fraud_review_ratio": guarded_ratio(
            F.col("fraud_review_count"), F.col("fraud_alert_count")
        ),
        "transactions_per_account": guarded_ratio(
            F.col("transaction_count"), F.col("account_count")
        ),
    }


def high_risk_label() -> Column:
    """1 for high-risk customers, judged on the rounded maximum score."""
    risky = (
        (F.col("risk_tier") == "high")
        | (F.col("maximum_fraud_risk_score") >= 0.85)
        | (F.col("fraud_review_count") >= 3)
        | (F.col("high_priority_case_count") >= 2)
    )
    return F.when(risky, 1).otherwise(0)


def customer_risk_features(customer_360: DataFrame) -> DataFrame:
    return feature_projection(customer_360).select(
        "*",
        *[column.alias(name) for name, column in ratios().items()],
        high_risk_label().alias("synthetic_high_risk_label"),
    )
