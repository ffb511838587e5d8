"""Registered queries against their SQL on the smallest tables."""

import glob
import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from workload import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
# One query per plan shape; the driver compares all of them.
NAMES = [
    "src_csv_roundtrip", "src_json_array_roundtrip", "src_jsonl_roundtrip", "bronze_row_hash",
    "std_trim_text", "std_full_transactions", "std_full_customers", "val_unique_key_nulls",
    "val_rejects", "val_reject_replay", "val_valid_rows_accounts", "val_null_currency_dropped", "val_transform_audit",
    "gold_account_agg", "gold_exact_sums", "gold_customer_360", "gold_daily_summary", "gold_product_performance",
    "ml_feature_table", "triage_table", "triage_top_rules_by_name", "rpt_kpis", "rpt_customer_sample", "gate_report",
    "full_refresh_product_performance",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def other_engine():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def ordered(names, rows):
    places = [names.index(n) for n in sorted(names)]
    return sorted(tuple((v is not None, str(v)) for v in (row[p] for p in places)) for row in rows)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(NAMES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, other_engine, name):
    df = entry_point.queries()[name](spark, FOLDER)
    cursor = other_engine.execute(entry_point.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.columns, df.collect()) == ordered(names, cursor.fetchall())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 25 and df.count() == 150
