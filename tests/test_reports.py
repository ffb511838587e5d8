import pytest

from oreflow.operators import checks, reports
from oreflow.sources import outputs, writers


def counts(spark, rows):
    return spark.createDataFrame(rows, reports.COUNT_SCHEMA)


def test_layer_counts_skip_missing_outputs(spark, tmp_path):
    root = str(tmp_path)
    assert reports.layer_counts(spark, root).count() == 0
    writers.replace_parquet(spark.range(3), outputs.output_path(root, "bronze_products"))
    writers.replace_parquet(spark.range(2), outputs.output_path(root, "gold_customer_360"))
    got = sorted(map(tuple, reports.layer_counts(spark, root).collect()))
    assert got == [("bronze", "bronze_products", 3), ("gold", "gold_customer_360", 2)]


def test_layers_cover_twenty_outputs():
    assert [(layer, len(t)) for layer, t in outputs.LAYERS.items()] == [
        ("bronze", 7), ("silver", 7), ("gold", 4), ("ml_features", 1), ("ai_automation", 1)]


def test_layer_summary(spark):
    df = counts(spark, [("silver", "a", 1), ("bronze", "b", 5), ("bronze", "c", 2), (None, "d", 9)])
    assert [tuple(r) for r in reports.layer_summary(df).collect()] == [
        ("bronze", 2, 7), ("silver", 1, 1)]


def test_kpis_of_missing_tables_are_zero(spark):
    board = spark.createDataFrame([(3,), (4,)], "total_reject_rule_hits bigint")
    labels = spark.createDataFrame([(1,), (0,), (1,)], "synthetic_high_risk_label int")
    got = {r.kpi: r.value for r in reports.kpis(counts(spark, []), board, labels).collect()}
    assert got == {"silver_transactions": 0, "customer_360_records": 0, "dq_rule_hits": 7,
                   "high_risk_customers": 2}
    some = counts(spark, [("silver", "silver_transactions", 8)])
    got = {r.kpi: r.value for r in reports.kpis(some, board, labels).collect()}
    assert got["silver_transactions"] == 8


def test_summaries_drop_null_groups(spark):
    mart = spark.createDataFrame(
        [("c1", "a", 2, 1.0), ("c2", "a", 4, 2.0), ("c3", None, 9, 9.0)],
        "customer_id string, customer_segment string, transaction_count bigint, "
        "total_current_balance double",
    )
    assert [tuple(r) for r in reports.segment_summary(mart).collect()] == [("a", 2, 3.0, 1.5)]
    table = spark.createDataFrame(
        [("c1", "low", 0), ("c2", None, 1), (None, "low", 0)],
        "customer_id string, risk_tier string, synthetic_high_risk_label int",
    )
    assert [tuple(r) for r in reports.risk_summary(table).collect()] == [("low", 0, 1)]


def test_checks(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert checks.null_keys(df, "k").first()[0] == 1
    assert tuple(checks.row_count_check(df, "t", 2).first()) == ("t", 2, 2, True)
    assert checks.row_count_check(df, "t", 3).first().passed is False


def test_gates(spark):
    customers = spark.createDataFrame([("c",)] * 98 + [(None,)] * 2, "customer_id string")
    ids = [(f"t{i}",) for i in range(998)] + [("t0",), (None,)]
    transactions = spark.createDataFrame(ids, "transaction_id string")
    accounts = spark.createDataFrame([(-1.0,), (1.0,), (None,)], "current_balance double")
    limits = checks.QualityLimits()
    gates = checks.quality_gates(customers, transactions, accounts, limits)
    got = {r.gate: (r.measured, r.passed) for r in gates.collect()}
    assert got == {
        "customer_id_completeness": (0.98, False),
        "transaction_id_completeness": (0.999, True),
        "duplicate_transaction_rate": (0.002, False),
        "negative_balance_rate": (0.5, False),
    }
    checks.enforce(gates, limits)
    with pytest.raises(checks.QualityBreach, match="customer_id_completeness"):
        checks.enforce(gates, checks.QualityLimits(fail_on_breach=True))
    empty = checks.quality_gates(*(d.limit(0) for d in (customers, transactions, accounts)))
    assert all(r.passed for r in empty.collect())
