"""Data-quality triage: who must do what about the rule hits of each dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Accountable owner per dataset and the fallback.
OWNERS = {
    "customers": "customer_data_steward",
    "accounts": "core_banking_data_owner",
    "products": "product_reference_data_steward",
    "transactions": "payments_data_engineering_team",
    "customer_service_notes": "customer_operations_data_steward",
    "exchange_rates_api": "external_reference_data_owner",
    "fraud_alert_events": "fraud_analytics_data_owner",
}
DEFAULT_OWNER = "enterprise_data_governance_team"

# Thresholds, labels and texts of the triage report.
ESCALATE_CRITICAL_HITS = 10
ESCALATE_ACCEPTANCE = 0.98
STATUSES = ("escalate_immediately", "investigate_this_sprint", "monitor", "no_action_required")
PRIORITIES = ("p1_high", "p2_medium", "p3_low", "p4_none")
PASSED_TEXT = (
    "%s passed the current data quality checks. %,d of %,d records were accepted into silver."
)
FAILED_TEXT = (
    "%s had %,d data quality rule hits. %,d of %,d records were accepted into silver "
    "for an acceptance rate of %.2f%%. The main issue patterns were: %s."
)
NO_RULES_TEXT = "unspecified validation rules"
ACTION_NONE = "Continue monitoring through scheduled pipeline checks."
ACTION_TRANSACTIONS = (
    "Review rejected transaction records, confirm source-system rules for required IDs, "
    "positive amounts, duplicate transaction IDs, and CAD currency standardization. "
    "Open a data quality issue with the payments data engineering team and confirm whether "
    "upstream validation or downstream quarantine logic should be adjusted."
)
ACTION_CRITICAL = (
    "Create a data quality issue, assign an accountable data owner, inspect rejected records, "
    "and confirm whether the rule failure is caused by upstream source quality, ingestion logic, "
    "or transformation logic."
)
ACTION_HIGH = (
    "Review the affected records during the next sprint and decide whether source-system "
    "validation or transformation rules need adjustment."
)
ACTION_DEFAULT = "Monitor trend over time and include in the next data quality review."

TOP_RULES = "top_rules"


def owner(dataset: Column) -> Column:
    known = F.create_map(*[F.lit(text) for pair in OWNERS.items() for text in pair])
    return F.coalesce(F.element_at(known, dataset), F.lit(DEFAULT_OWNER))


def issue_id(dataset: Column) -> Column:
    return F.concat(F.lit("DQ-"), F.translate(F.upper(dataset), "_", "-"))


def _graded(labels: tuple[str, str, str, str]) -> Column:
    """One of four labels, worst first. An unknown acceptance rate does not escalate."""
    critical, high = F.col("critical_reject_rule_hits"), F.col("high_reject_rule_hits")
    severe = (critical >= ESCALATE_CRITICAL_HITS) | (
        F.col("acceptance_rate") < ESCALATE_ACCEPTANCE
    )
    return (
        F.when(severe, labels[0])
        .when((critical > 0) | (high > 0), labels[1])
        .when(F.col("total_reject_rule_hits") > 0, labels[2])
        .otherwise(labels[3])
    )


def status() -> Column:
    return _graded(STATUSES)


def priority() -> Column:
    return _graded(PRIORITIES)


def summary(top_rules: Column) -> Column:
    """The state of a dataset in one or more sentences, naming at most three rules."""
    dataset, total = F.col("dataset_name"), F.col("total_reject_rule_hits")
    silver, bronze = F.col("silver_row_count"), F.col("bronze_row_count")
    named = F.array_join(F.slice(top_rules, 1, 3), ", ")
    rules = F.when(F.size(top_rules) > 0, named).otherwise(NO_RULES_TEXT)
    percent = F.coalesce(F.col("acceptance_rate"), F.lit(float("nan"))) * 100
    return F.when(total == 0, F.format_string(PASSED_TEXT, dataset, silver, bronze)).otherwise(
        F.format_string(FAILED_TEXT, dataset, total, silver, bronze, percent, rules)
    )


def recommended_action() -> Column:
    return (
        F.when(F.col("total_reject_rule_hits") == 0, ACTION_NONE)
        .when(F.col("dataset_name") == "transactions", ACTION_TRANSACTIONS)
        .when(F.col("critical_reject_rule_hits") > 0, ACTION_CRITICAL)
        .when(F.col("high_reject_rule_hits") > 0, ACTION_HIGH)
        .otherwise(ACTION_DEFAULT)
    )


def top_failed_rules(rejects: DataFrame, limit: int = 5) -> DataFrame:
    """The most frequent rules per dataset, rendered as ``rule (n hits)`` in an array.

    Takes reject records, or counts in ``rule_hits``.

    The window runs over the counts, one row per dataset and rule.
    """
    counted = "rule_hits" in rejects.columns
    hits = F.sum("rule_hits") if counted else F.count(F.lit(1))
    counts = rejects.groupBy("dataset_name", "rule_name").agg(hits.alias("rule_hits"))
    order = Window.partitionBy("dataset_name").orderBy(F.desc("rule_hits"), "rule_name")
    text = F.concat("rule_name", F.lit(" ("), F.col("rule_hits").cast("string"), F.lit(" hits)"))
    ranked = counts.withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= limit
    )
    listed = F.array_sort(F.collect_list(F.struct("place", text.alias("text"))))
    return ranked.groupBy("dataset_name").agg(listed.getField("text").alias(TOP_RULES))


# Rules of one dataset by their number of hits; takes :dataset and :places.
RULES_BY_NAME = """SELECT rule_name, count(*) AS rule_hits
    FROM {silver_data_quality_rejects} WHERE dataset_name = :dataset
    GROUP BY rule_name ORDER BY rule_hits DESC, rule_name LIMIT :places"""


def ordered_dashboard(dashboard: DataFrame) -> DataFrame:
    """Worst dataset first."""
    # Columns of the ordered dashboard.
    return dashboard.select(
        "dataset_name",
        "bronze_table",
        "silver_table",
        "bronze_row_count",
        "silver_row_count",
        "acceptance_rate",
        "critical_reject_rule_hits",
        "high_reject_rule_hits",
        "medium_reject_rule_hits",
        "total_reject_rule_hits",
        "processed_at_utc",
        "status",
    ).orderBy(F.desc("total_reject_rule_hits"), "dataset_name")


def with_top_rules(dashboard: DataFrame, rejects: DataFrame) -> DataFrame:
    """Dashboard rows with their rules; an empty array where a dataset has none."""
    none = F.array().cast("array<string>")
    return dashboard.join(top_failed_rules(rejects), "dataset_name", "left").withColumn(
        TOP_RULES, F.coalesce(TOP_RULES, none)
    )


def triage_table(dashboard: DataFrame, rejects: DataFrame, created_at: str) -> DataFrame:
    """One triage record per dataset, worst first."""
    rules = F.col(TOP_RULES)
    dataset = F.col("dataset_name")
    return (
        with_top_rules(dashboard, rejects)
        .select(
            issue_id(dataset).alias("issue_id"),
            "dataset_name",
            "bronze_table",
            "silver_table",
            F.round("acceptance_rate", 4).alias("acceptance_rate"),
            "critical_reject_rule_hits",
            "high_reject_rule_hits",
            "medium_reject_rule_hits",
            "total_reject_rule_hits",
            F.when(F.size(rules) > 0, F.array_join(rules, "; "))
            .otherwise("none")
            .alias("top_failed_rules"),
            priority().alias("priority"),
            status().alias("triage_status"),
            owner(dataset).alias("recommended_owner"),
            summary(rules).alias("plain_language_summary"),
            recommended_action().alias("recommended_action"),
            F.lit(created_at).alias("created_at_utc"),
        )
        .orderBy(F.desc("total_reject_rule_hits"), "dataset_name")
    )


def issue_log(triage: DataFrame) -> DataFrame:
    """The governance view of the triage table."""
    # Columns of the issue log.
    return triage.select(
        "issue_id",
        "dataset_name",
        "priority",
        "triage_status",
        "recommended_owner",
        "plain_language_summary",
        "recommended_action",
        "created_at_utc",
    )
