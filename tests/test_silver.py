import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oreflow.model import HIGH, DatasetSpec, Rule
from oreflow.operators import bronze, quality, standardize
from oreflow.operators.masks import not_equal
from oreflow.operators.uniqueness import BROADCAST_BYTES, mark_repeated, with_place
from oreflow.registry import DATASETS, SOURCES

TS = "2024-05-01 12:00:00"


def frame(spark, names, rows, kind="string"):
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {kind}" for n in names.split()))


def test_load_metadata_and_hash_scope(spark):
    df = frame(spark, "a b", [("1", "x"), ("1", "x")])
    first, second = (
        bronze.to_bronze(df, load_id=i, ingested_at=TS, source_system="s", source_file="f.csv")
        for i in ("l1", "l2")
    )
    assert first.columns == [
        "a", "b", "_bronze_load_id", "_ingested_at_utc", "_source_file", "_source_system",
        "_raw_row_hash",
    ]
    hashes = [{r["_raw_row_hash"] for r in d.collect()} for d in (first, second)]
    assert len(hashes[0]) == 1 and hashes[0] != hashes[1]
    sources = [
        {r["h"] for r in bronze.add_row_hash(d, include_metadata=False, name="h").collect()}
        for d in (first, second)
    ]
    assert sources[0] == sources[1]


def test_headers(spark):
    df = frame(spark, "A", [("1",)]).toDF(" Customer_ID ")
    assert standardize.normalize_headers(df).columns == ["customer_id"]
    with pytest.raises(ValueError, match="collide"):
        standardize.normalize_headers(frame(spark, "a b", [("1", "2")]).toDF("A", "a "))


def test_technical_columns_stay_untrimmed(spark):
    df = standardize.trim_text(frame(spark, "a _b", [(" x\t", " y ")]))
    assert tuple(df.first()) == ("x", " y ")


def test_standardize_transactions(spark):
    names = "Transaction_ID amount currency transaction_timestamp is_international channel"
    df = frame(spark, names, [
        (" t1 ", " 12.5 ", "\tCad", "2024-03-04 05:06:07", "True", " Web "),
        ("t2", "NaN", None, "later", "x", None),
    ])
    out = standardize.standardize(df, TS)
    assert out.columns == [
        "transaction_id", "amount", "currency", "transaction_timestamp", "is_international",
        "channel", "transaction_date", "_silver_processed_at_utc",
    ]
    one, two = out.orderBy("transaction_id").collect()
    assert (one.transaction_id, one.amount, one.currency, one.channel) == ("t1", 12.5, "cad", "web")
    assert str(one.transaction_timestamp) == "2024-03-04 05:06:07"
    assert str(one.transaction_date) == "2024-03-04" and one.is_international is True
    assert tuple(two)[1:7] == (None, None, None, None, None, None)
    assert two._silver_processed_at_utc == TS


def brute_force(rows):
    counts = Counter(k for _, k in rows)
    return sorted((i, counts[k] > 1) for i, k in rows)


# (broadcast_bytes, hot_keys): broadcast, no heavy key but null, few heavy keys, all heavy.
@pytest.mark.parametrize(("limit", "hot"), [(1 << 20, 10), (0, 1), (0, 4), (0, 10_000)])
@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_repeated_keys_match_brute_force(spark, limit, hot, kind):
    random.seed(7)
    keys = [0] * 700 + [None] * 400 + [random.randrange(1, 600) for _ in range(900)]
    keys += list(range(1000, 1300))
    random.shuffle(keys)
    if kind == "string":
        keys = [k if k is None else f"k{k}" for k in keys]
    rows = list(enumerate(keys))
    df = spark.createDataFrame(rows, f"i int, k {kind}").repartition(6)
    marked = mark_repeated(df, "k", "again", broadcast_bytes=limit, hot_keys=hot)
    assert marked.columns == ["i", "k", "again"]
    assert sorted((r.i, r.again) for r in marked.collect()) == brute_force(rows)


# (hot_keys, marks_bytes): no heavy key but null, few heavy keys, all heavy, marks too large.
@pytest.mark.parametrize(("hot", "most"), [(1, 1 << 20), (4, 1 << 20), (10_000, 1 << 20), (4, 0)])
def test_repeated_rows_of_stored_files_match_brute_force(spark, tmp_path, hot, most):
    """By their places in files of several blocks, read by several tasks; wide rows stay where they are."""
    number = F.col("id")
    key = F.when(number % 97 == 0, None).when(number % 5 == 0, "heavy").otherwise((F.abs(F.hash(number)) % 90_000).cast("string"))
    df = spark.range(80_000, numPartitions=2).select("id", key.alias("file"))
    df.write.option("parquet.block.size", 100_000).parquet(f"{tmp_path}/t")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        stored = with_place(spark.read.parquet(f"{tmp_path}/t"))
        assert stored.rdd.getNumPartitions() > 2
        marked = mark_repeated(stored, "file", "again", broadcast_bytes=0, hot_keys=hot, marks_bytes=most)
        found = marked.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert marked.columns == ["id", "file", "again"]
    assert sorted((r.id, r.again) for r in found) == brute_force([(r.id, r.file) for r in found])
    assert len(found) == 80_000
    assert ("hashpartitioning" in marked._jdf.queryExecution().executedPlan().toString()) == (most == 0)


@pytest.mark.parametrize("keys", [["a", "a"], ["a", "b", None], []])
@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_places_are_taken_off(spark, tmp_path, keys, limit):
    rows = list(enumerate(keys))
    spark.createDataFrame(rows, "i int, k string").write.parquet(f"{tmp_path}/t")
    stored = with_place(spark.read.schema("i int, k string").parquet(f"{tmp_path}/t"))
    marked = mark_repeated(stored, "k", "again", broadcast_bytes=limit)
    assert marked.columns == ["i", "k", "again"]
    assert sorted((r.i, r.again) for r in marked.collect()) == brute_force(rows)


@pytest.mark.parametrize("keys", [["a", "b", None], ["a", "a"], [None, None], []])
@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_repeated_keys_small_cases(spark, keys, limit):
    rows = list(enumerate(keys))
    df = spark.createDataFrame(rows, "i int, k string")
    marked = mark_repeated(df, "k", "again", broadcast_bytes=limit)
    assert sorted((r.i, r.again) for r in marked.collect()) == brute_force(rows)


def test_long_heavy_keys_are_not_broadcast(spark):
    rows = list(enumerate(["x" * 5000] * 6 + ["y" * 4096] * 6 + [None, None, "a", "b", "b"]))
    df = spark.createDataFrame(rows, "i int, k string")
    marked = mark_repeated(df, "k", "again", broadcast_bytes=0, hot_keys=10)
    assert sorted((r.i, r.again) for r in marked.collect()) == brute_force(rows)


def test_hot_rows_are_spread_over_reducers(spark):
    """A key with most rows must not land in one shuffle partition."""
    df = spark.range(40_000, numPartitions=16).select(
        "id", F.when(F.col("id") % 4 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    df = df.union(df.filter("k <> 'hot'"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = mark_repeated(df, "k", "again", broadcast_bytes=0, hot_keys=10)
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
        assert marked.filter("again").count() == marked.count() == 50_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4 and max(sizes) < 25_000


def checked(spark, **options):
    names = ["transaction_id", "account_id", "customer_id", "amount", "currency"]
    rows = [
        ("t1", "a", "c", 1.0, "cad"),
        ("t2", "a", None, -1.0, "usd"),      # three rules at once
        ("t3", "a", "c", 1.0, None),         # undecided: no reject, not valid
        ("t4", "a", "c", 1.0, "cad"),
        ("t4", "a", " ", float("inf"), "cad"),
        (None, "a", "c", 2.0, None),         # one null key is no duplicate
    ]
    df = spark.createDataFrame(
        rows, "transaction_id string, account_id string, customer_id string, amount double, "
        "currency string"
    )
    assert df.columns == names
    return quality.flag_rules(df, DATASETS["transactions"], **options)


def test_flags_and_split(spark):
    flagged = checked(spark)
    spec = DATASETS["transactions"]
    assert [r.transaction_id for r in quality.valid_rows(flagged).collect()] == ["t1"]
    records = quality.reject_records(flagged, spec, TS)
    assert records.columns == quality.REJECT_SCHEMA.names
    hits = Counter((r.rule_name, r.severity) for r in records.collect())
    assert hits == {
        ("customer_id_required", "critical"): 2,
        ("amount_must_be_positive", "critical"): 1,
        ("currency_must_be_cad", "high"): 1,
        ("transaction_id_must_be_unique", "critical"): 2,
        ("transaction_id_required", "critical"): 1,
    }
    audit = quality.transform_audit(flagged, spec, TS).first()
    assert (audit.bronze_row_count, audit.silver_row_count, audit.rejected_rule_hits) == (6, 1, 7)
    assert audit.bronze_row_count > audit.silver_row_count + 4  # t3 left without a record


def test_strict_nulls_reject_the_undecided(spark):
    flagged = checked(spark, strict_nulls=True)
    row = flagged.filter("transaction_id = 't3'").first()
    assert row[quality.RULE_HITS] == "currency_must_be_cad" and row[quality.ROW_VALID] is False


def test_reject_payload_is_the_whole_row(spark):
    df = spark.sql(
        "SELECT 'e1' AS event_id, CAST(NULL AS STRING) AS transaction_id, 'a' AS account_id, "
        "2.5D AS risk_score, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS event_timestamp, "
        "true AS flag, DATE'2024-01-02' AS d"
    )
    spec = DATASETS["fraud_alert_events"]
    records = quality.reject_records(quality.flag_rules(df, spec), spec, TS).collect()
    assert {r.rule_name for r in records} == {
        "transaction_id_required", "risk_score_between_zero_and_one",
    }
    assert json.loads(records[0].record_payload_json) == {
        "event_id": "e1", "transaction_id": None, "account_id": "a", "risk_score": 2.5,
        "event_timestamp": "2024-01-02 03:04:05", "flag": True, "d": "2024-01-02",
    }


def test_score_bounds_are_inclusive(spark):
    scores = [-0.001, 0.0, 1.0, 1.001, None]
    df = spark.createDataFrame(
        [(f"e{i}", "t", "a", s) for i, s in enumerate(scores)],
        "event_id string, transaction_id string, account_id string, risk_score double",
    )
    valid = quality.valid_rows(quality.flag_rules(df, DATASETS["fraud_alert_events"]))
    assert sorted(r.risk_score for r in valid.collect()) == [0.0, 1.0]


def test_absent_columns_skip_their_rules(spark):
    df = spark.createDataFrame([("p1",)], "other string")
    flagged = quality.flag_rules(df, DATASETS["products"])
    assert quality.valid_rows(flagged).count() == 1


def test_no_rejects_give_a_typed_empty_frame(spark):
    empty = quality.union_rejects(spark, [])
    assert empty.schema == quality.REJECT_SCHEMA and empty.count() == 0


def test_empty_dataset(spark):
    df = spark.createDataFrame([], "case_id string, customer_id string")
    spec = DATASETS["customer_service_notes"]
    audit = quality.transform_audit(quality.flag_rules(df, spec), spec, TS).first()
    assert (audit.bronze_row_count, audit.silver_row_count, audit.rejected_rule_hits) == (0, 0, 0)


def test_own_dataset_spec(spark):
    spec = DatasetSpec("own", ("id",), None, (Rule("is_x", HIGH, "v", not_equal("x")),))
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, v string")
    records = quality.reject_records(quality.flag_rules(df, spec), spec, TS).collect()
    assert [(r.dataset_name, r.rule_name, r.severity) for r in records] == [("own", "is_x", "high")]
    with pytest.raises(ValueError, match="identifiers"):
        Rule("a,b", HIGH, "v", not_equal("x"))


def test_wide_rows_are_not_shuffled_for_a_small_key_set(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "product_id string, s string")
    plan = mark_repeated(df, "product_id", "again")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_wide_rows_are_neither_routed_nor_sorted_without_heavy_keys(spark):
    df = spark.range(400).selectExpr("cast(id % 300 as string) AS k", "id")
    marked = mark_repeated(df, "k", "again", broadcast_bytes=0, hot_keys=10)
    plan = marked._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "route_slot" not in plan
    assert {(r.id, r.again) for r in marked.collect()} == {(i, i % 300 < 100) for i in range(400)}


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_code_by_places_is_small_enough_to_be_compiled(spark, capsys, tmp_path, limit):
    names = SOURCES["transactions"].schema.names
    rows = spark.range(9).select(*[(F.col("id") % 5).cast("string").alias(n) for n in names])
    loaded = bronze.to_bronze(rows, load_id="a", ingested_at="b", source_system="c", source_file="d")
    loaded.write.parquet(f"{tmp_path}/bronze")
    loaded = with_place(spark.read.parquet(f"{tmp_path}/bronze"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cleaned = standardize.standardize(loaded, TS)
        quality.flag_rules(cleaned, DATASETS["transactions"], stripped=True, broadcast_bytes=limit).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_code_of_a_dataset_is_small_enough_to_be_compiled(spark, capsys, tmp_path):
    """The JVM compiles no method of over 8,000 bytes."""
    names = SOURCES["transactions"].schema.names
    rows = spark.range(9).select(*[F.col("id").cast("string").alias(n) for n in names])
    loaded = bronze.to_bronze(rows, load_id="a", ingested_at="b", source_system="c", source_file="d")
    loaded.write.parquet(f"{tmp_path}/bronze")
    loaded = spark.read.parquet(f"{tmp_path}/bronze")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cleaned = standardize.standardize(loaded, TS)
        quality.flag_rules(cleaned, DATASETS["transactions"], stripped=True).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
