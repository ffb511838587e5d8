"""Refreshes over sources without valid rows, repeated refreshes, the program, scratch data."""

import os
import time

import pytest
from pyspark.sql import functions as F

from oreflow.functions import stable_avg, stable_sum, strip, to_ntz
from oreflow.functions.text import WHITESPACE
from oreflow.main import main
from oreflow.operators import quality, reports, uniqueness
from oreflow.plans import refresh as steps
from oreflow.plans.refresh import refresh
from oreflow.registry import DATASETS, SOURCES
from oreflow.session import refresh_settings, shared_folder, staged
from oreflow.sources import outputs, writers

TS = "2024-05-01 12:00:00"
ROWS = {
    "customers": [("C1", "A", "B", "ON", "retail", "low", "2020-01-02", "True")],
    "products": [("P1", "loan", "loan", "lending")],
    "accounts": [("A1", "C1", "P1", "active", "2021-01-01", "5.25", "CAD")],
    "transactions": [("T1", "A1", "C1", "2024-03-04 05:06:07", "purchase", "web", "x", "2.5", "CAD", "True", "api")],
    "customer_service_notes": [("S1", "C1", "2024-01-01", "x", "high", "note", "open")],
    "exchange_rates_api": [("2024-01-01", "CAD", "USD", "1.5", "api", "2024-01-02")],
    "fraud_alert_events": [("E1", "T1", "C1", "A1", "2024-03-04 05:06:07", "0.9", "r", "review", "f")],
}


def write_raw(spark, folder, **changed):
    for name, rows in (ROWS | changed).items():
        spec = SOURCES[name]
        df = spark.createDataFrame(rows, spec.schema)
        path = f"{folder}/{spec.file_name}"
        if spec.file_format == "csv":
            writers.replace_csv(df.coalesce(1), path)
        elif spec.file_format == "json":
            df.coalesce(1).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).write.mode("overwrite").text(path)
        else:
            df.select(F.to_json(F.struct("*"))).write.mode("overwrite").text(path)
    return str(folder)


def counts(spark, out):
    return {r.table_name: r.row_count for r in reports.layer_counts(spark, out).collect()}


@pytest.mark.parametrize("accounts", [[("A1", "C1", "P1", "active", "2021-01-01", "5.25", "USD")], []])
def test_silver_without_valid_rows(spark, tmp_path, accounts):
    out = str(tmp_path / "out")
    refresh(spark, write_raw(spark, tmp_path / "raw", accounts=accounts), out)
    silver = outputs.load_output(spark, out, "silver_accounts")
    assert silver.count() == 0 and silver.schema["current_balance"].dataType.simpleString() == "double"
    found = counts(spark, out)
    assert len(found) == 20 and found["silver_accounts"] == 0 and found["silver_transactions"] == 1
    board = outputs.load_output(spark, out, "gold_data_quality_dashboard").filter("dataset_name = 'accounts'").first()
    assert (board.bronze_row_count, board.total_reject_rule_hits) == (len(accounts), len(accounts))


def test_a_corrected_file_leaves_no_stale_quarantine(spark, tmp_path):
    out, raw = str(tmp_path / "out"), tmp_path / "raw"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        wrong = [*ROWS["accounts"], ("A2", "C1", "P1", "active", "2021-01-01", "1", "USD")]
        refresh(spark, write_raw(spark, raw, accounts=wrong), out, run_ts=TS, load_id="1")
        refresh(spark, write_raw(spark, raw), out, run_ts=TS, load_id="2")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    board = outputs.load_output(spark, out, "gold_data_quality_dashboard").filter("dataset_name = 'accounts'").first()
    assert (board.bronze_row_count, board.total_reject_rule_hits) == (1, 0)
    assert len(counts(spark, out)) == 20


def test_program_publishes_tables(spark, tmp_path):
    before = set(os.listdir(shared_folder(spark).removeprefix("file://")))
    main(["--raw", write_raw(spark, tmp_path / "raw"), "--out", str(tmp_path / "out"), "--database", "bank", "--gates"])
    assert set(os.listdir(shared_folder(spark).removeprefix("file://"))) == before
    assert spark.table("bank.gold_data_quality_dashboard").count() == len(DATASETS)
    bronze = spark.table("bank.bronze_customers").first()
    assert bronze["_source_file"].startswith("part-") and len(bronze["_bronze_load_id"]) == 36
    assert spark.table("bank.silver_accounts").columns == outputs.silver_schema(spark, "accounts").names
    assert spark.table("bank.governance_issue_log").count() == len(DATASETS)


@pytest.mark.parametrize("values, expected", [
    ([1e-10] * 1000, 1e-7),
    ([4e-10] * 1000, 4e-7),
    ([1e15, 0.5, -1e15], 0.5),
    ([float("inf"), 1.0], float("inf")),
    ([2.0**53, 2.0, 0.25], 2.0**53 + 2),
    ([None, None], None),
    ([0.1] * 10, 1.0),
])
def test_sums_drop_nothing(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    total = df.select(stable_sum(F.col("v"))).first()[0]
    assert total == (expected if expected is None else pytest.approx(expected, rel=1e-12))


def test_many_fractions_of_one_sign(spark):
    # 0.499999999 * 4e7 adds up to fractions of over 2**54.
    row = spark.range(40_000_000).select(F.lit(0.499999999).alias("v")).agg(stable_sum(F.col("v")), stable_avg(F.col("v"))).first()
    assert row[0] == pytest.approx(0.499999999 * 4e7, abs=1e-6) and row[1] == pytest.approx(0.499999999, abs=1e-15)


def test_all_white_space_goes(column):
    texts = [c + "a b" + d for c in WHITESPACE for d in WHITESPACE] + ["éa", "aé", "a ", "　", "", " ", "~", "!x!", "x\x7f", "\x7fx"]
    assert column(texts, strip("v")) == [t.strip(WHITESPACE) for t in texts]


def test_zones_are_taken_to_utc(column):
    texts = ["2024-01-01T10:00:00+05:00", "2024-01-01T10:00:00Z", "2024-01-01 10:00:00-0330", "2024-01-01 10:00:00 Europe/Berlin", "2024-01-01 10:00:00", "2024-01-01", "2024-01-01T10:00:00.5+00:00", "no date at all", "2024-01-01-01-01-01"]
    got = [None if v is None else v.isoformat(" ") for v in column(texts, to_ntz("v"))]
    assert got == ["2024-01-01 05:00:00", "2024-01-01 10:00:00", "2024-01-01 13:30:00", "2024-01-01 09:00:00", "2024-01-01 10:00:00", "2024-01-01 00:00:00", "2024-01-01 10:00:00.500000", None, None]


def test_one_pass_for_quality_numbers(spark, tmp_path):
    from workload import catalog

    folder = "/root/testdata/sf0.001"
    if not os.path.exists(folder):
        pytest.skip("no test tables")
    for name in ("gold_dq_dashboard", "triage_table"):
        plan = catalog.queries()[name](spark, folder)._jdf.queryExecution().toString()
        assert "lineitem" not in plan  # read once, when the profile was stored
    frame = quality.rule_profile(catalog.flagged(spark, folder, "transactions"), DATASETS["transactions"])
    assert frame._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") <= 1


def test_a_refresh_sorts_no_wide_rows_before_it_writes_them(spark, tmp_path, monkeypatch):
    """Neither checked tables by outcome, in a session left at Spark's default, nor rejects to deal them in turn."""
    setting, plans, found = "spark.sql.maxConcurrentOutputFileWriters", {}, []
    store, check = steps.replace_parquet, steps.write_checked

    def stored(df, path):
        plans[os.path.basename(path)] = df._jdf.queryExecution().executedPlan().toString()
        store(df, path)

    def checked(flagged, path):
        found.append(int(spark.conf.get(setting)))
        check(flagged, path)

    monkeypatch.setattr(steps, "replace_parquet", stored)
    monkeypatch.setattr(steps, "write_checked", checked)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "0")
    try:
        accounts = [("A1", "C1", "P1", "active", "2021-01-01", "5.25", "USD")]
        refresh(spark, write_raw(spark, tmp_path / "raw", accounts=accounts), str(tmp_path / "out"))
        after = spark.conf.get(setting)
    finally:
        spark.conf.set(setting, before)
    assert after == "0" and len(found) == len(DATASETS) and min(found) >= 3
    (rejects,) = [plan for name, plan in plans.items() if "rejects" in name]
    assert "REBALANCE" in rejects and "RoundRobin" not in rejects


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_step_that_wrote_them(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, at = spark.conf.get(setting), shuffle_files(spark)
    held = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    with refresh_settings(spark):
        with refresh_settings(spark):
            assert sorted(tuple(r) for r in staged(held, "held").collect())[0] == (0, 15)
        assert spark.conf.get(setting) == "true"
        path = str(tmp_path / "raw")
        write_raw(spark, path)
    refresh(spark, path, str(tmp_path / "out"))
    assert spark.conf.get(setting) == before
    for _ in range(100):  # they go in the background
        left = shuffle_files(spark) - at
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_many_rejects_are_not_shuffled_to_be_written(spark, tmp_path, monkeypatch):
    plans, store = {}, steps.replace_parquet

    def stored(df, path):
        plans[os.path.basename(path)] = df._jdf.queryExecution().executedPlan().toString()
        store(df, path)

    monkeypatch.setattr(steps, "replace_parquet", stored)
    monkeypatch.setattr(steps, "FEW_REJECTS", 2)
    accounts = [(f"A{k}", "C1", "P1", "active", "2021-01-01", "5.25", "USD") for k in range(3)]
    products = [("P1", None, "loan", "lending"), ("P1", "loan", "loan", "lending")]  # three hits: too many as well
    customers = [("", "A", "B", "ON", "retail", "low", "2020-01-02", "True")]
    for name, changed, parts in (("many", {}, 0), ("both", {"customers": customers}, 1)):
        raw, out = str(tmp_path / name / "raw"), str(tmp_path / name / "out")
        write_raw(spark, raw, accounts=accounts, products=products, **changed)
        refresh(spark, raw, out)
        (plan,) = [plan for table, plan in plans.items() if "rejects" in table]
        assert plan.count("REBALANCE") == parts
        rejects = outputs.load_output(spark, out, "silver_data_quality_rejects")
        found = sorted((r.dataset_name, r["count"]) for r in rejects.groupBy("dataset_name").count().collect())
        assert found == [("accounts", 3), *([("customers", 1)] if changed else []), ("products", 3)]


def test_a_refresh_with_very_many_repeated_keys_shuffles_no_wide_rows(spark, tmp_path, monkeypatch):
    check, plans = steps.write_checked, {}

    def checked(flagged, path):
        plans[os.path.basename(path)] = flagged._jdf.queryExecution().executedPlan().toString()
        check(flagged, path)

    monkeypatch.setattr(steps, "write_checked", checked)
    monkeypatch.setitem(uniqueness.mark_repeated.__kwdefaults__, "broadcast_bytes", 0)
    first, raw, out = ROWS["transactions"][0], str(tmp_path / "raw"), str(tmp_path / "out")
    ids = ["T1", " T1", "T2", "T3", "T3 ", "T3"]
    write_raw(spark, raw, transactions=[(i, *first[1:]) for i in ids])
    refresh(spark, raw, out)
    assert "hashpartitioning" not in plans["silver_transactions.parquet"]
    silver = outputs.load_output(spark, out, "silver_transactions")
    assert [r.transaction_id for r in silver.collect()] == ["T2"] and "_row_place" not in silver.columns
    rejects = outputs.load_output(spark, out, "silver_data_quality_rejects").filter("dataset_name = 'transactions'")
    assert [r.rule_name for r in rejects.collect()] == ["transaction_id_must_be_unique"] * 5
    assert rejects.filter("record_payload_json LIKE '%_row_place%'").count() == 0
