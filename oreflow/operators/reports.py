"""The queries behind the monitoring report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from oreflow.functions import round_half_away, stable_avg
from oreflow.sources.outputs import LAYERS, load_output

COUNT_SCHEMA = StructType(
    [
        StructField("layer", StringType()),
        StructField("table_name", StringType()),
        StructField("row_count", LongType()),
    ]
)
SAMPLE_ROWS = 100


def row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count of each (layer, table), as one plan."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
        )
        for (layer, table), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_counts(spark: SparkSession, root: str) -> DataFrame:
    """Row counts of all stored outputs; missing ones are skipped."""
    found = {}
    for layer, tables in LAYERS.items():
        for table in tables:
            try:
                found[layer, table] = load_output(spark, root, table)
            except FileNotFoundError:
                continue
    return row_counts(found) if found else spark.createDataFrame([], COUNT_SCHEMA)


def layer_summary(counts: DataFrame) -> DataFrame:
    return (
        counts.filter(F.col("layer").isNotNull())
        .groupBy("layer")
        .agg(
            F.count("table_name").alias("table_count"),
            F.sum("row_count").alias("total_rows"),
        )
        .orderBy("layer")
    )


def kpis(counts: DataFrame, dashboard: DataFrame, features: DataFrame) -> DataFrame:
    """The four headline numbers; counts of missing tables are 0."""

    def table_rows(table: str) -> DataFrame:
        rows = F.max(F.when(F.col("table_name") == table, F.col("row_count")))
        return F.coalesce(rows, F.lit(0)).alias(table)

    parts = [
        counts.agg(table_rows("silver_transactions"), table_rows("gold_customer_360")).select(
            F.expr("stack(2, 'silver_transactions', silver_transactions,"
                   " 'customer_360_records', gold_customer_360) as (kpi, value)")
        ),
        dashboard.agg(F.coalesce(F.sum("total_reject_rule_hits"), F.lit(0)).alias("value")).select(
            F.lit("dq_rule_hits").alias("kpi"), "value"
        ),
        features.agg(
            F.coalesce(F.sum("synthetic_high_risk_label"), F.lit(0)).alias("value")
        ).select(F.lit("high_risk_customers").alias("kpi"), "value"),
    ]
    return reduce(DataFrame.unionByName, parts)


def data_quality_display(dashboard: DataFrame) -> DataFrame:
    # Columns of the display.
    return dashboard.select(
        "dataset_name",
        "bronze_row_count",
        "silver_row_count",
        round_half_away(F.col("acceptance_rate") * 100, 2).alias("acceptance_rate_pct"),
        "critical_reject_rule_hits",
        "high_reject_rule_hits",
        "total_reject_rule_hits",
    )


def rule_hits(dashboard: DataFrame) -> DataFrame:
    return dashboard.select("dataset_name", "total_reject_rule_hits")


def triage_display(triage: DataFrame) -> DataFrame:
    # Columns of the display.
    return triage.select(
        "issue_id",
        "dataset_name",
        "priority",
        "triage_status",
        "recommended_owner",
        "total_reject_rule_hits",
        "plain_language_summary",
        "recommended_action",
    )


def customer_sample(customer_360: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first customers by id."""
    # Columns of the display.
    return (
        customer_360.select(
            "customer_id",
            "province",
            "customer_segment",
            "risk_tier",
            "account_count",
            "transaction_count",
            "total_transaction_amount",
            "fraud_alert_count",
            "service_case_count",
        )
        .orderBy("customer_id")
        .limit(rows)
    )


def segment_summary(customer_360: DataFrame) -> DataFrame:
    """Customers and their mean activity per segment; customers without one are left out."""
    return (
        customer_360.filter(F.col("customer_segment").isNotNull())
        .groupBy("customer_segment")
        .agg(
            F.count("customer_id").alias("customers"),
            F.avg("transaction_count").alias("avg_transactions"),
            stable_avg(F.col("total_current_balance")).alias("avg_balance"),
        )
    )


def product_totals(product_performance: DataFrame) -> DataFrame:
    return product_performance.select("product_name", "total_transaction_amount")


def risk_summary(features: DataFrame) -> DataFrame:
    """Customers per risk tier and label; customers without a tier are left out."""
    return (
        features.filter(F.col("risk_tier").isNotNull())
        .groupBy("risk_tier", "synthetic_high_risk_label")
        .agg(F.count("customer_id").alias("customers"))
    )


def activity_points(features: DataFrame) -> DataFrame:
    # Columns of the display.
    return features.select(
        "transaction_count",
        "maximum_fraud_risk_score",
        "fraud_alert_count",
        "customer_id",
        "risk_tier",
        "customer_segment",
    )


def feature_sample(features: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first feature rows by customer id."""
    # Columns of the display.
    return (
        features.select(
            "customer_id",
            "province",
            "customer_segment",
            "risk_tier",
            "transaction_count",
            "international_transaction_ratio",
            "fraud_review_ratio",
            "synthetic_high_risk_label",
        )
        .orderBy("customer_id")
        .limit(rows)
    )
