"""A whole refresh over raw files that carry the faults of the golden run."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from oreflow.operators.checks import QualityBreach, QualityLimits
from oreflow.plans.refresh import refresh
from oreflow.registry import DATASETS
from oreflow.sources import outputs, writers

TS = "2024-05-01 12:00:00"


def raw_transactions(spark):
    i = F.col("id")
    rows = spark.range(1, 12_001, numPartitions=4).select(
        F.format_string("TXN%09d", i).alias("transaction_id"),
        F.format_string("ACCT%07d", i % 2013 + 1).alias("account_id"),
        F.when(i <= 8, None).otherwise(F.format_string("CUST%06d", i % 1000 + 1)).alias(
            "customer_id"),
        F.lit("2024-03-04 05:06:07").alias("transaction_timestamp"),
        F.lit("purchase").alias("transaction_type"),
        F.lit("web").alias("channel"),
        F.lit("grocery").alias("merchant_category"),
        F.when(i.between(9, 14), -1.0).otherwise(i / 100).alias("amount"),
        F.when(i.between(15, 20), "UNKNOWN").otherwise("CAD").alias("currency"),
        F.when(i % 10 == 0, "True").otherwise("False").alias("is_international"),
        F.lit("payments_api").alias("ingestion_source"),
    )
    return rows.union(rows.filter(F.col("transaction_id").endswith("00500")).withColumn(
        "transaction_id", F.explode(F.array(*[F.lit(f"TXN{n:09d}") for n in range(501, 506)]))))


def write_raw(spark, folder):
    i = F.col("id")
    customer = F.format_string("CUST%06d", i)
    csv = {
        "customers": spark.range(1, 1001).select(
            customer.alias("customer_id"), F.lit("A").alias("first_name"),
            F.lit("B").alias("last_name"), F.lit("ON").alias("province"),
            F.lit("retail").alias("customer_segment"), F.lit("low").alias("risk_tier"),
            F.lit("2020-01-02").alias("created_at"), F.lit("True").alias("is_active")),
        "accounts": spark.range(1, 2014).select(
            F.format_string("ACCT%07d", i).alias("account_id"),
            F.format_string("CUST%06d", i % 1000 + 1).alias("customer_id"),
            F.format_string("PRD%03d", i % 7 + 1).alias("product_id"),
            F.lit("active").alias("account_status"), F.lit("2021-01-01").alias("opened_at"),
            (i * 1.5).alias("current_balance"), F.lit("CAD").alias("currency")),
        "products": spark.range(1, 9).select(
            F.format_string("PRD%03d", i).alias("product_id"), F.lit("loan").alias("product_name"),
            F.lit("loan").alias("product_type"), F.lit("lending").alias("business_domain")),
        "transactions": raw_transactions(spark),
        "customer_service_notes": spark.range(1, 301).select(
            F.format_string("CASE%06d", i).alias("case_id"), customer.alias("customer_id"),
            F.lit("2024-01-01 00:00:00").alias("created_at"), F.lit("x").alias("issue_type"),
            F.lit("high").alias("priority"), F.lit('a "b", c').alias("case_note"),
            F.lit("open").alias("case_status")),
    }
    for name, df in csv.items():
        writers.replace_csv(df, f"{folder}/{name}.csv")
    rates = spark.range(120).select(
        F.lit("2024-01-01").alias("rate_date"), F.lit("CAD").alias("base_currency"),
        F.lit("USD").alias("target_currency"), (i / 100 + 1).alias("exchange_rate"),
        F.lit("api").alias("source_system"), F.lit("2024-01-02 00:00:00").alias("loaded_at"))
    rates.agg(F.to_json(F.collect_list(F.struct(*rates.columns)))).write.text(
        f"{folder}/exchange_rates_api.json")
    alerts = spark.range(1, 501).select(
        F.format_string("EVT%07d", i).alias("event_id"),
        F.format_string("TXN%09d", i).alias("transaction_id"), customer.alias("customer_id"),
        F.format_string("ACCT%07d", i).alias("account_id"),
        F.lit("2024-03-04 05:06:07").alias("event_timestamp"),
        (i / 1000).alias("risk_score"), F.lit("new_location").alias("alert_reason"),
        F.lit("monitor").alias("recommended_action"), F.lit("feed").alias("event_source"))
    alerts.select(F.to_json(F.struct("*"))).write.text(f"{folder}/fraud_alert_events.jsonl")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    write_raw(spark, folder)
    return folder


@pytest.fixture(scope="module")
def out(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("out"))
    for _ in range(2):  # the second run replaces the first
        refresh(spark, raw, root, run_ts=TS, load_id="load-1", limits=QualityLimits())
    return root


def load(spark, out, table):
    return outputs.load_output(spark, out, table)


def test_every_output_exists_with_its_size(spark, out):
    sizes = {name: load(spark, out, name).count() for name in outputs.PATHS}
    assert sizes["gold_data_quality_dashboard"] == sizes["ai_pipeline_triage"] == 7
    assert sizes["gold_customer_360"] == sizes["ml_customer_risk_features"] == 1000
    assert (sizes["bronze_transactions"], sizes["silver_transactions"]) == (12005, 11975)
    assert sizes["silver_data_quality_rejects"] == 30 and sizes["gold_product_performance"] == 8
    assert sizes["bronze_load_audit"] == sizes["silver_transform_audit"] == 7
    assert sizes["quality_gates"] == 4 and sizes["governance_issue_log"] == 7


def test_transactions_are_flagged(spark, out):
    row = load(spark, out, "gold_data_quality_dashboard").filter(
        "dataset_name = 'transactions'").first()
    assert (row.total_reject_rule_hits, row.critical_reject_rule_hits) == (30, 24)
    assert 0.99 <= row.acceptance_rate < 1.0
    issue = load(spark, out, "ai_pipeline_triage").filter("dataset_name = 'transactions'").first()
    assert (issue.priority, issue.triage_status, issue.recommended_owner) == (
        "p1_high", "escalate_immediately", "payments_data_engineering_team")


def test_silver_holds_the_data_columns_only(spark, out):
    bronze, silver = (load(spark, out, f"{layer}_transactions") for layer in ("bronze", "silver"))
    assert silver.columns == [*bronze.columns, "transaction_date", "_silver_processed_at_utc"]
    assert silver.schema["amount"].dataType.simpleString() == "double"


def test_valid_and_rejected_rows_are_disjoint(spark, out):
    rejects = load(spark, out, "silver_data_quality_rejects")
    ids = rejects.select(
        F.get_json_object("record_payload_json", "$.transaction_id").alias("transaction_id"))
    silver = load(spark, out, "silver_transactions")
    assert silver.join(ids.distinct(), "transaction_id").count() == 0


def test_sums_survive_the_marts(spark, out):
    silver = load(spark, out, "silver_transactions").agg(F.sum("amount"), F.count("*")).first()
    daily = load(spark, out, "gold_daily_transaction_summary").agg(
        F.sum("total_transaction_amount"), F.sum("transaction_count")).first()
    assert daily[0] == pytest.approx(silver[0]) and daily[1] == silver[1]
    mart = load(spark, out, "gold_customer_360")
    assert mart.agg(F.sum("transaction_count")).first()[0] == silver[1]
    assert mart.filter("customer_id IS NULL").count() == 0


def test_load_audit(spark, out):
    row = load(spark, out, "bronze_load_audit").filter("dataset_name = 'transactions'").first()
    assert tuple(row) == ("load-1", "transactions", "transactions.csv",
                          "payments_and_card_platforms", "csv", 12005, 16, TS, "success")
    assert load(spark, out, "bronze_load_audit").count() == len(DATASETS)


def test_a_missing_source_stops_the_run(spark, tmp_path):
    with pytest.raises(AnalysisException):
        refresh(spark, str(tmp_path / "none"), str(tmp_path / "o"), run_ts=TS, load_id="l")


def test_breached_limits_stop_the_run_where_asked(spark, raw, tmp_path):
    limits = QualityLimits(maximum_duplicate_transaction_rate=0.0, fail_on_breach=True)
    with pytest.raises(QualityBreach, match="duplicate_transaction_rate"):
        refresh(spark, raw, str(tmp_path), run_ts=TS, load_id="l", limits=limits)
    assert outputs.load_output(spark, str(tmp_path), "quality_gates").count() == 4
