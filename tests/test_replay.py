"""Quarantined rows checked again, and questions with bound values."""

from oreflow.operators import quality, replay, triage
from oreflow.operators.standardize import standardize
from oreflow.registry import DATASETS
from oreflow.sources import outputs, writers

TS = "2024-05-01 12:00:00"
SPEC = DATASETS["products"]
UNIQUE = quality.unique_rule("product_id")


def flagged(spark, rows):
    names = "product_id string, product_name string, product_type string, business_domain string"
    return quality.flag_rules(standardize(spark.createDataFrame(rows, names), TS), SPEC, stripped=True)


def replayed(spark, rows, silver_rows=(), settled=(UNIQUE,)):
    rejects = quality.reject_records(flagged(spark, rows), SPEC, TS)
    silver = quality.valid_rows(flagged(spark, list(silver_rows)))
    again = replay.replay(rejects, SPEC, silver, TS, settled=settled)
    return again, sorted(r.product_id for r in quality.valid_rows(again).collect())


def test_rows_whose_key_became_unique_pass(spark):
    rows = [
        ("P1", "loan", 'a "b", c', "x"), ("P1", None, "t", "x"),  # the other copy broke a further rule
        ("P2", "card", "t", "x"), ("P2", "card", "t", "x"),  # delivered twice
        ("P3", "one", "t", "x"), ("P3", "two", "t", "x"),  # still two rows
        ("P4", None, "t", "x"), (None, "n", "t", "x"),
    ]
    again, passed = replayed(spark, rows)
    assert passed == ["P1", "P2"]
    assert sorted(r.product_id for r in again.collect()) == ["P1", "P2", "P3", "P3"]
    found = quality.valid_rows(again).filter("product_id = 'P1'").first()
    assert found.product_type == 'a "b", c'
    assert replayed(spark, rows, [("P1", "now", "t", "x")])[1] == ["P2"]  # silver holds it by now
    assert replayed(spark, rows, settled=[])[1] == []
    assert replayed(spark, [])[1] == []


def test_rows_to_check_again_are_stored_once(spark):
    """Their keys and the rows are both read from there, and no shuffle that led to them stays or comes again."""
    again, passed = replayed(spark, [("P1", "loan", "t", "x"), ("P1", None, "t", "x"), ("P2", "card", "t", "x")])
    plan = again._jdf.queryExecution().toString()
    assert passed == ["P1"] and "record_payload_json" not in plan and "/replayed-" in plan


def test_fields_by_path(spark):
    df = spark.createDataFrame([('{"a b": "x", "n": 1.5, "t": true, "z": null}',)], "record_payload_json string")
    row = replay.with_record(df).select(
        replay.field("a b"), replay.field("n", "double"), replay.field("t", "boolean"),
        replay.field("z"), replay.field("none"), replay.field("a b", "int"),
    ).first()
    assert tuple(row) == ("x", 1.5, True, None, None, None)


def test_quotes_in_values_are_harmless(spark, tmp_path):
    root = str(tmp_path)
    names = ["plain", "it's", "x' OR '1'='1", '"', "a;b -- c"]
    rows = [(n, f"r{k}") for n in names for k in (1, 1, 2)]
    rejects = spark.createDataFrame(rows, "dataset_name string, rule_name string")
    writers.replace_parquet(rejects, outputs.output_path(root, "silver_data_quality_rejects"))
    for name in [*names, "nobody'"]:
        found = outputs.ask(spark, root, triage.RULES_BY_NAME, dataset=name, places=5)
        assert [tuple(r) for r in found.collect()] == ([] if name not in names else [("r1", 2), ("r2", 1)])
    assert outputs.ask(spark, root, triage.RULES_BY_NAME, dataset="it's", places=1).count() == 1
    both = outputs.ask(spark, root, "SELECT count(*) AS n FROM {silver_data_quality_rejects} a JOIN {silver_data_quality_rejects} b USING (rule_name) WHERE a.dataset_name IN (:x, :y)", x="it's", y="plain")
    assert both.first().n == 2 * (2 * 10 + 5)
