import pytest
from pyspark.sql import functions as F

from oreflow.operators import gold, quality, triage

# Run time, row counts and rule hits of the golden run.
TS = "2026-05-27 21:34:38"
COUNTS = {  # accepted input sizes of the golden run
    "transactions": (12005, 11975),
    "accounts": (2013, 2013),
    "customer_service_notes": (300, 300),
    "customers": (1000, 1000),
    "exchange_rates_api": (120, 120),
    "fraud_alert_events": (500, 500),
    "products": (8, 8),
}
HITS = {
    ("transaction_id_must_be_unique", "critical"): 10,
    ("customer_id_required", "critical"): 8,
    ("amount_must_be_positive", "critical"): 6,
    ("currency_must_be_cad", "high"): 6,
}


def audit(spark, counts, hits=0):
    return quality.audit_table(spark, [
        {"dataset_name": n, "bronze_table": f"bronze_{n}", "silver_table": f"silver_{n}",
         "bronze_row_count": b, "silver_row_count": s, "rejected_rule_hits": hits,
         "processed_at_utc": TS, "status": "success"}
        for n, (b, s) in counts.items()
    ])


def rejects(spark, dataset, hits):
    rows = [(dataset, rule, severity, TS, "{}") for (rule, severity), n in hits.items()
            for _ in range(n)]
    return spark.createDataFrame(rows, quality.REJECT_SCHEMA)


def test_golden_run(spark):
    bad = rejects(spark, "transactions", HITS)
    board = gold.data_quality_dashboard(audit(spark, COUNTS), bad)
    rows = triage.triage_table(board, bad, TS).collect()
    assert [r.dataset_name for r in rows] == list(COUNTS)  # worst first, then by name
    first = rows[0].asDict()
    assert first == {
        "issue_id": "DQ-TRANSACTIONS",
        "dataset_name": "transactions",
        "bronze_table": "bronze_transactions",
        "silver_table": "silver_transactions",
        "acceptance_rate": 0.9975,
        "critical_reject_rule_hits": 24,
        "high_reject_rule_hits": 6,
        "medium_reject_rule_hits": 0,
        "total_reject_rule_hits": 30,
        "top_failed_rules": "transaction_id_must_be_unique (10 hits); customer_id_required "
        "(8 hits); amount_must_be_positive (6 hits); currency_must_be_cad (6 hits)",
        "priority": "p1_high",
        "triage_status": "escalate_immediately",
        "recommended_owner": "payments_data_engineering_team",
        "plain_language_summary": "transactions had 30 data quality rule hits. 11,975 of 12,005 "
        "records were accepted into silver for an acceptance rate of 99.75%. The main issue "
        "patterns were: transaction_id_must_be_unique (10 hits), customer_id_required (8 hits), "
        "amount_must_be_positive (6 hits).",
        "recommended_action": triage.ACTION_TRANSACTIONS,
        "created_at_utc": TS,
    }
    for row in rows[1:]:
        bronze = COUNTS[row.dataset_name][0]
        assert (row.acceptance_rate, row.top_failed_rules, row.priority, row.triage_status) == (
            1.0, "none", "p4_none", "no_action_required")
        assert row.plain_language_summary == (
            f"{row.dataset_name} passed the current data quality checks. {bronze:,} of "
            f"{bronze:,} records were accepted into silver.")
        assert row.recommended_action == triage.ACTION_NONE
        assert row.recommended_owner == triage.OWNERS[row.dataset_name]
    log = triage.issue_log(triage.triage_table(board, bad, TS))
    assert log.columns == ["issue_id", "dataset_name", "priority", "triage_status",
                           "recommended_owner", "plain_language_summary", "recommended_action",
                           "created_at_utc"]


@pytest.mark.parametrize(("critical", "high", "total", "rate", "place"), [
    (10, 0, 10, 1.0, 0), (0, 0, 0, 0.9799, 0), (9, 0, 9, 0.98, 1), (0, 1, 1, 0.99, 1),
    (0, 0, 1, 0.99, 2), (0, 0, 0, 1.0, 3), (0, 0, 0, None, 3),
])
def test_grades(spark, critical, high, total, rate, place):
    df = spark.createDataFrame(
        [(critical, high, total, rate)],
        "critical_reject_rule_hits bigint, high_reject_rule_hits bigint, "
        "total_reject_rule_hits bigint, acceptance_rate double",
    )
    got = df.select(triage.status(), triage.priority()).first()
    assert tuple(got) == (triage.STATUSES[place], triage.PRIORITIES[place])


@pytest.mark.parametrize(("dataset", "critical", "high", "total", "want"), [
    ("transactions", 0, 0, 0, triage.ACTION_NONE),
    ("transactions", 0, 0, 1, triage.ACTION_TRANSACTIONS),
    ("accounts", 1, 1, 2, triage.ACTION_CRITICAL),
    ("accounts", 0, 1, 1, triage.ACTION_HIGH),
    ("accounts", 0, 0, 1, triage.ACTION_DEFAULT),
])
def test_actions(spark, dataset, critical, high, total, want):
    df = spark.createDataFrame(
        [(dataset, critical, high, total)],
        "dataset_name string, critical_reject_rule_hits bigint, high_reject_rule_hits bigint, "
        "total_reject_rule_hits bigint",
    )
    assert df.select(triage.recommended_action()).first()[0] == want


def test_unknown_owner_and_issue_id(spark):
    df = spark.createDataFrame([("new_feed_x",)], "d string")
    got = df.select(triage.owner(F.col("d")), triage.issue_id(F.col("d"))).first()
    assert tuple(got) == ("enterprise_data_governance_team", "DQ-NEW-FEED-X")


def test_top_rules_break_ties_by_name_and_stop_at_five(spark):
    hits = {(name, "high"): n for name, n in
            [("f", 1), ("b", 3), ("a", 3), ("e", 1), ("d", 2), ("c", 2)]}
    top = triage.top_failed_rules(rejects(spark, "x", hits)).first()
    assert top[triage.TOP_RULES] == ["a (3 hits)", "b (3 hits)", "c (2 hits)", "d (2 hits)",
                                     "e (1 hits)"]


def test_summary_without_known_rules(spark):
    board = gold.data_quality_dashboard(audit(spark, {"x": (4, 3)}),
                                        rejects(spark, "x", {("a", "medium"): 1}))
    none = spark.createDataFrame([], quality.REJECT_SCHEMA)
    text = triage.triage_table(board, none, TS).first()
    assert text.plain_language_summary.endswith("were: unspecified validation rules.")
    assert text.medium_reject_rule_hits == 1 and text.top_failed_rules == "none"


def test_empty_bronze_has_no_rate_and_does_not_escalate(spark):
    none = spark.createDataFrame([], quality.REJECT_SCHEMA)
    board = gold.data_quality_dashboard(audit(spark, {"products": (0, 0)}), none)
    row = triage.triage_table(board, none, TS).first()
    assert row.acceptance_rate is None and row.priority == "p4_none"
