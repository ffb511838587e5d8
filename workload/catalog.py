"""One Spark query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions import exact_sums, layouts, round_half_away, stable_avg, stable_sum
from oreflow.model import DatasetSpec
from oreflow.operators import (
    bronze,
    checks,
    features,
    gold,
    quality,
    replay,
    reports,
    standardize,
    triage,
)
from oreflow.plans.refresh import refresh
from oreflow.registry import DATASETS, SOURCES
from oreflow.session import refresh_settings, scratch_path, staged
from oreflow.sources import outputs, readers, writers
from workload.oracles import KEYS, LOAD, TS
from workload.roles import role, table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- building blocks ---------------------------------------------------------


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return role(spark, folder, f"raw_{name}")


def standardized(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return standardize.standardize(raw(spark, folder, name), TS)


def flagged(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return quality.flag_rules(standardized(spark, folder, name), DATASETS[name], stripped=True)


def all_flagged(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven flagged datasets; their key checks run side by side."""
    task = inheritable_thread_target(spark)(lambda name: flagged(spark, folder, name))
    with ThreadPoolExecutor(max_workers=len(DATASETS)) as pool:
        return dict(zip(DATASETS, pool.map(task, DATASETS), strict=True))


def keyed_rejects(frame: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Reject records with the key read back out of their JSON text."""
    records = quality.reject_records(frame, spec, TS)
    key = F.get_json_object("record_payload_json", f"$.{KEYS[spec.name]}")
    return records.withColumn("record_key", key).drop("record_payload_json")


def payloads(frame: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Reject records with the whole row read back out of their JSON text."""
    columns = T.StructType([frame.schema[name] for name in quality.data_columns(frame)])
    return quality.parsed_payload(quality.reject_records(frame, spec, TS), columns)


def profile_of(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by verdict and broken rules of all datasets, from one pass over each; stored once."""
    parts = [
        quality.rule_profile(df, DATASETS[name])
        for name, df in all_flagged(spark, folder).items()
    ]
    return staged(reduce(DataFrame.unionByName, parts), "rule-profile")


def audit_of(profile: DataFrame) -> DataFrame:
    return quality.profile_audit(profile, DATASETS.values(), TS)


def hits_of(profile: DataFrame) -> DataFrame:
    return quality.profile_hits(profile, DATASETS.values())


def dashboard(spark: SparkSession, folder: str) -> DataFrame:
    profile = profile_of(spark, folder)
    return gold.data_quality_dashboard(audit_of(profile), hits_of(profile))


def triage_frame(spark: SparkSession, folder: str) -> DataFrame:
    profile = profile_of(spark, folder)
    hits = hits_of(profile)
    return triage.triage_table(gold.data_quality_dashboard(audit_of(profile), hits), hits, TS)


def customer_360(spark: SparkSession, folder: str) -> DataFrame:
    return gold.customer_360(
        *(
            role(spark, folder, name)
            for name in (
                "customers", "accounts", "transactions", "fraud_alert_events",
                "customer_service_notes",
            )
        )
    )


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return features.customer_risk_features(customer_360(spark, folder))


def products(spark: SparkSession, folder: str) -> DataFrame:
    return gold.product_performance(
        *(role(spark, folder, name) for name in ("products", "accounts", "transactions"))
    )


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Sums and means of doubles depend on the order of addition in their last bits."""
    return df.withColumns({c: round_half_away(F.col(c), n) for c, n in digits.items()})


def write_lines(df: DataFrame, path: str, **options: object) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.options(**options).text(path)


def write_arrays(df: DataFrame, path: str, rows_per_file: int = 500) -> None:
    """A folder of JSON-array files with at most ``rows_per_file`` objects each."""
    chunk = F.floor(F.monotonically_increasing_id() / rows_per_file).alias("chunk")
    arrays = (
        df.select(F.struct("*").alias("row"), chunk)
        .groupBy("chunk")
        .agg(F.to_json(F.collect_list("row")).alias("value"))
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


def write_raw_files(spark: SparkSession, folder: str) -> str:
    """The raw roles as files in the formats the registry expects, packed but for the small arrays."""
    landing = scratch_path(spark, "raw")

    def write(name: str) -> None:
        spec = SOURCES[name]
        path = f"{landing}/{spec.file_name}"
        frame = raw(spark, folder, name)
        if spec.file_format == "csv":
            writers.replace_csv(frame, path, packed=True)
        elif spec.file_format == "json":
            write_arrays(frame, path)
        else:
            write_lines(frame, path, **writers.PACKED_TEXT)

    with refresh_settings(spark), ThreadPoolExecutor(max_workers=len(SOURCES)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), SOURCES))
    return landing


def refreshed(spark: SparkSession, folder: str) -> str:
    """Output folder of a whole refresh over the raw roles."""
    out = scratch_path(spark, "refresh")
    refresh(spark, write_raw_files(spark, folder), out, run_ts=TS, load_id=LOAD)
    return out


# --- sources and sinks -------------------------------------------------------


@query
def src_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.replace_csv(raw(spark, folder, "customer_service_notes"), path)
    return readers.read_csv(spark, path, SOURCES["customer_service_notes"].schema)


@query
def src_json_array_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json")
    write_arrays(raw(spark, folder, "exchange_rates_api"), path)
    return readers.read_json_array(spark, path, SOURCES["exchange_rates_api"].schema)


@query
def src_json_array_split(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as arrays, one file for each task that writes, read in ranges by several tasks."""

    def one_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The objects of a task as the lines of one array, as they come."""
        before = "["
        for batch in batches:
            lines = []
            for value in batch.column(0).to_pylist():
                lines.append(before + value)
                before = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"])], names=["value"])

    path = scratch_path(spark, "array")
    rows = table(spark, folder, "orders").select(F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")).alias("value"))
    rows.mapInArrow(one_array, "value string").write.text(path)
    schema = T.StructType([T.StructField(n, t) for n, t in (("o_orderkey", T.LongType()), ("o_custkey", T.LongType()), ("o_totalprice", T.DoubleType()), ("o_orderstatus", T.StringType()), ("o_orderpriority", T.StringType()))])
    return readers.read_json_array(spark, path, schema, range_bytes=256 << 10)


@query
def src_csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in files with other columns in another order, line breaks inside values, read in ranges."""
    path = scratch_path(spark, "headers")
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source")
    # Texts that the reader would take as missing, or that hold a carriage return alone, are no case here.
    docs = docs.withColumn("text", F.concat(F.lit("<"), F.regexp_replace("text", "\r", "\n"), F.lit(">")))
    kinds = {
        0: docs,
        1: docs.select("source", "text", F.lit("new").alias("added"), "doc_id", "lang"),
        2: docs.select("text", "doc_id", "lang"),
    }
    for kind, rows in kinds.items():
        part = rows.filter(F.col("doc_id").cast("long") % 3 == kind)
        (
            part.write.option("header", True).option("escape", '"').option("quoteAll", True).option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/kind-{kind}")
        )
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("lang", "text", "source")]])
    return readers.read_csv(spark, path, schema, multi_line=True, missing_as_null=True, range_bytes=256 << 10)


@query
def src_jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    documents = table(spark, folder, "documents")
    write_lines(documents, path)
    return readers.read_json_lines(spark, path, documents.schema)


@query
def src_registry_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    landing = write_raw_files(spark, folder)
    counts = [
        readers.read_raw(spark, spec, landing)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.lit(spec.name).alias("dataset_name"),
            F.lit(spec.file_format).alias("file_format"),
            F.lit(spec.source_system).alias("source_system"),
            "row_count",
        )
        for spec in SOURCES.values()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def src_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scan")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writers.replace_table(role(spark, folder, "transactions"), name, path)
    return readers.read_table(spark, name)


@query
def src_parquet_scan(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_parquet(spark, f"{folder}/lineitem.parquet")


@query
def output_loader(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "outputs")
    writers.replace_parquet(
        dashboard(spark, folder), outputs.output_path(out, "gold_data_quality_dashboard")
    )
    return outputs.load_output(spark, out, "gold_data_quality_dashboard")


@query
def snk_table_replace(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "replaced")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writers.replace_table(role(spark, folder, "transactions"), name, path)
    writers.replace_table(role(spark, folder, "accounts"), name, path)
    return spark.table(name)


@query
def snk_parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    writers.replace_parquet(role(spark, folder, "products"), path)
    writers.replace_parquet(role(spark, folder, "fraud_alert_events"), path)
    return readers.read_parquet(spark, path)


@query
def snk_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "report")
    writers.replace_csv(
        triage_frame(spark, folder), outputs.output_path(out, "ai_pipeline_triage"),
        single_file=True,
    )
    return outputs.load_output(spark, out, "ai_pipeline_triage")


@query
def table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.row_counts(
        {("bronze", f"bronze_{name}"): raw(spark, folder, name) for name in DATASETS}
    )


# --- bronze ------------------------------------------------------------------


def customer_metadata(spark: SparkSession, folder: str) -> DataFrame:
    spec = SOURCES["customers"]
    return bronze.add_load_metadata(
        raw(spark, folder, "customers"),
        load_id=LOAD,
        ingested_at=TS,
        source_system=spec.source_system,
        source_file=spec.file_name,
    )


@query
def bronze_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return customer_metadata(spark, folder)


@query
def bronze_metadata_files(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of part files: every row names the file it came from."""
    path = scratch_path(spark, "parts")
    spec = SOURCES["customers"]
    writers.replace_csv(raw(spark, folder, "customers").repartition(3), path)
    rows = bronze.add_load_metadata(
        readers.read_csv(spark, path, spec.schema),
        load_id=LOAD,
        ingested_at=TS,
        source_system=spec.source_system,
    )
    names = [row[0] for row in rows.select("_source_file").distinct().collect()]
    told = F.col("_source_file").rlike(r"^part-.*\.csv$") & F.lit(len(names) == 3)
    return rows.select(*spec.schema.names, told.alias("names_its_file"))


@query
def bronze_row_hash(spark: SparkSession, folder: str) -> DataFrame:
    rows = customer_metadata(spark, folder)
    full = bronze.add_row_hash(rows)
    return bronze.add_row_hash(full, include_metadata=False, name="source_hash")


@query
def bronze_load_audit(spark: SparkSession, folder: str) -> DataFrame:
    audits = []
    for spec in SOURCES.values():
        rows = bronze.to_bronze(
            raw(spark, folder, spec.name),
            load_id=LOAD,
            ingested_at=TS,
            source_system=spec.source_system,
            source_file=spec.file_name,
        )
        audits.append(
            bronze.count_load(
                rows,
                load_id=LOAD,
                dataset_name=spec.name,
                source_file=spec.file_name,
                source_system=spec.source_system,
                file_format=spec.file_format,
                loaded_at=TS,
            )
        )
    return reduce(DataFrame.unionByName, audits)


# --- standardisation ---------------------------------------------------------


@query
def std_headers(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw(spark, folder, "customers").select(
        F.col("customer_id").alias(" Customer_ID "),
        F.col("first_name").alias("FIRST_NAME"),
        F.col("last_name").alias("Last_Name "),
        "province",
    )
    return standardize.normalize_headers(rows)


@query
def std_trim_text(spark: SparkSession, folder: str) -> DataFrame:
    return standardize.trim_text(role(spark, folder, "dirty_documents"))


@query
def std_dates(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw(spark, folder, "transactions").select("transaction_id", "transaction_timestamp")
    return standardize.coerce_dates(rows)


@query
def std_dates_zoned(spark: SparkSession, folder: str) -> DataFrame:
    """The same column with a zone on most values: they are taken to UTC."""
    rows = role(spark, folder, "transactions")
    zone = F.element_at(F.array(*map(F.lit, ("+05:00", "-0330", "Z", ""))), F.col("transaction_id").cast("int") % 4 + 1)
    text = F.concat(F.date_format("transaction_timestamp", "yyyy-MM-dd'T'10:mm:ss"), zone)
    return standardize.coerce_dates(rows.select("transaction_id", text.alias("transaction_timestamp")))


#: Layouts that one column each of `dates_in_layouts` is written in.
WRITTEN = {
    "us": "MM/dd/yyyy", "eu": "dd.MM.yyyy", "slashed": "yyyy/M/d", "named": "d MMM yyyy", "digits": "yyyyMMdd", "half_day": "yyyy-MM-dd hh:mm a",
}


def dates_in_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Ship dates of all lines as text: a layout a column, one column of two orders, one that tells neither."""
    shipped = F.col("l_shipdate")
    early = F.make_date(F.year(shipped), F.month(shipped), F.dayofmonth(shipped) % 12 + 1)
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *[F.date_format(shipped, pattern).alias(name) for name, pattern in WRITTEN.items()],
        F.when(F.col("l_linenumber") % 2 == 0, F.date_format(shipped, "dd/MM/yyyy")).otherwise(F.date_format(shipped, "MM/dd/yyyy")).alias("mixed"),
        F.date_format(early, "dd-MM-yyyy").alias("open"),
    )


@query
def std_date_layouts(spark: SparkSession, folder: str) -> DataFrame:
    rows = dates_in_layouts(spark, folder)
    names = [*WRITTEN, "mixed", "open"]
    settled = layouts.settle_layouts(layouts.count_layouts(rows, names))
    return standardize.coerce_dates(rows, names, settled)


@query
def std_date_layout_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = dates_in_layouts(spark, folder)
    return layouts.layout_report(layouts.count_layouts(rows, [*WRITTEN, "mixed", "open"]))


@query
def std_numerics(spark: SparkSession, folder: str) -> DataFrame:
    return standardize.coerce_numbers(
        raw(spark, folder, "transactions").select("transaction_id", "amount")
    )


@query
def std_lowercase(spark: SparkSession, folder: str) -> DataFrame:
    return standardize.lowercase(
        raw(spark, folder, "accounts").select("account_id", "account_status", "currency")
    )


@query
def std_transaction_date(spark: SparkSession, folder: str) -> DataFrame:
    return standardize.add_transaction_date(
        role(spark, folder, "transactions").select("transaction_id", "transaction_timestamp")
    )


def _per_dataset(prefix: str, build: Callable[[SparkSession, str, str], DataFrame]) -> None:
    for name in DATASETS:
        _QUERIES[f"{prefix}_{name}"] = lambda spark, folder, name=name: build(spark, folder, name)


_per_dataset("std_full", standardized)


# --- validation --------------------------------------------------------------


def _rule(key: str, dataset: str, rule: str) -> None:
    """A single rule's reject records."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        records = keyed_rejects(flagged(spark, folder, dataset), DATASETS[dataset])
        return records.filter(F.col("rule_name") == rule).drop("rejected_at_utc")

    _QUERIES[key] = run


_rule("val_required", "transactions", "customer_id_required")
_rule("val_unique_key", "transactions", "transaction_id_must_be_unique")
_rule("val_unique_key_nulls", "customers", "customer_id_must_be_unique")
_rule("val_positive_amount", "transactions", "amount_must_be_positive")
_rule("val_currency_transactions", "transactions", "currency_must_be_cad")
_rule("val_currency_accounts", "accounts", "currency_must_be_cad")
_rule("val_positive_rate", "exchange_rates_api", "exchange_rate_must_be_positive")
_rule("val_score_range", "fraud_alert_events", "risk_score_between_zero_and_one")

_per_dataset(
    "val_valid_rows",
    lambda spark, folder, name: quality.valid_rows(flagged(spark, folder, name)),
)


@query
def val_null_currency_dropped(spark: SparkSession, folder: str) -> DataFrame:
    rows = flagged(spark, folder, "accounts")
    undecided = F.col(quality.ROW_VALID).isNull() & (F.col(quality.RULE_HITS) == "")
    return rows.filter(undecided).select("account_id", "customer_id", "current_balance")


@query
def val_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return keyed_rejects(flagged(spark, folder, "transactions"), DATASETS["transactions"])


@query
def val_reject_union(spark: SparkSession, folder: str) -> DataFrame:
    frames = all_flagged(spark, folder)
    return quality.union_rejects(
        spark, [keyed_rejects(df, DATASETS[name]) for name, df in frames.items()]
    )


@query
def val_transform_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_of(profile_of(spark, folder))


@query
def val_reject_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions rejected for their key alone, whose other copies broke further rules: they pass now."""
    spec = DATASETS["transactions"]
    with refresh_settings(spark):
        # Stored as by a refresh: rejects and silver are both read from it.
        frame = staged(flagged(spark, folder, spec.name), "flagged", compression=writers.COMPRESSION)
    rejects = quality.reject_records(frame, spec, TS)
    silver = quality.valid_rows(frame)
    again = replay.replay(rejects, spec, silver, TS, settled=[quality.unique_rule(spec.unique_key)])
    return quality.valid_rows(again)


_per_dataset(
    "val_reject_payload",
    lambda spark, folder, name: payloads(flagged(spark, folder, name), DATASETS[name]),
)


# --- gold and features -------------------------------------------------------


@query
def gold_account_agg(spark: SparkSession, folder: str) -> DataFrame:
    totals = gold.account_totals(role(spark, folder, "accounts"))
    return rounded(totals, total_current_balance=2, average_current_balance=2)


@query
def gold_transaction_agg(spark: SparkSession, folder: str) -> DataFrame:
    totals = gold.transaction_totals(role(spark, folder, "transactions"))
    return rounded(totals, total_transaction_amount=2, average_transaction_amount=2)


@query
def gold_fraud_agg(spark: SparkSession, folder: str) -> DataFrame:
    totals = gold.fraud_totals(role(spark, folder, "fraud_alert_events"))
    return rounded(totals, average_fraud_risk_score=3, maximum_fraud_risk_score=3)


@query
def gold_service_agg(spark: SparkSession, folder: str) -> DataFrame:
    return gold.service_totals(role(spark, folder, "customer_service_notes"))


@query
def gold_fine_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Values with more decimals than sums keep apart: nothing may be lost."""
    value = F.col("value") / 250 / 7
    sums = table(spark, folder, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), stable_sum(value).alias("total"), stable_avg(value).alias("mean")
    )
    return rounded(sums, total=6, mean=9)


@query
def gold_exact_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The same to the last bit, for any order of the rows."""
    sums = exact_sums(table(spark, folder, "events"), ["event_type"], F.col("value") / 250 / 7)
    return rounded(sums, total=6, mean=9)


@query
def gold_customer_360(spark: SparkSession, folder: str) -> DataFrame:
    return customer_360(spark, folder)


@query
def gold_daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_transaction_summary(role(spark, folder, "transactions"))


@query
def gold_account_transactions(spark: SparkSession, folder: str) -> DataFrame:
    totals = gold.account_transactions(role(spark, folder, "transactions"))
    return rounded(totals, total_transaction_amount=2, average_transaction_amount=2)


@query
def gold_product_performance(spark: SparkSession, folder: str) -> DataFrame:
    return products(spark, folder)


@query
def gold_reject_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.reject_summary(hits_of(profile_of(spark, folder)))


@query
def gold_dq_dashboard(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard(spark, folder)


@query
def ml_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.feature_projection(customer_360(spark, folder))


@query
def ml_ratios(spark: SparkSession, folder: str) -> DataFrame:
    named = [column.alias(name) for name, column in features.ratios().items()]
    return customer_360(spark, folder).select("customer_id", *named)


@query
def ml_high_risk_label(spark: SparkSession, folder: str) -> DataFrame:
    return customer_360(spark, folder).select(
        "customer_id",
        "risk_tier",
        "maximum_fraud_risk_score",
        "fraud_review_count",
        "high_priority_case_count",
        features.high_risk_label().alias("synthetic_high_risk_label"),
    )


@query
def ml_feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return feature_table(spark, folder)


# --- triage ------------------------------------------------------------------


@query
def triage_owner(spark: SparkSession, folder: str) -> DataFrame:
    owner = triage.owner(F.col("dataset_name")).alias("recommended_owner")
    return dashboard(spark, folder).select("dataset_name", owner)


@query
def triage_status(spark: SparkSession, folder: str) -> DataFrame:
    status = triage.status().alias("triage_status")
    return dashboard(spark, folder).select("dataset_name", status)


@query
def triage_priority(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard(spark, folder).select("dataset_name", triage.priority().alias("priority"))


@query
def triage_issue_id(spark: SparkSession, folder: str) -> DataFrame:
    issue = triage.issue_id(F.col("dataset_name")).alias("issue_id")
    return dashboard(spark, folder).select("dataset_name", issue)


@query
def triage_action(spark: SparkSession, folder: str) -> DataFrame:
    action = triage.recommended_action().alias("recommended_action")
    return dashboard(spark, folder).select("dataset_name", action)


@query
def triage_top_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = triage.top_failed_rules(hits_of(profile_of(spark, folder)))
    listed = F.array_join(triage.TOP_RULES, "; ").alias("top_failed_rules")
    return rules.select("dataset_name", listed)


@query
def triage_top_rules_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The rules of one stored dataset, asked for with bound values."""
    root = scratch_path(spark, "asked")
    frame = flagged(spark, folder, "transactions")
    rejects = quality.reject_records(frame, DATASETS["transactions"], TS)
    writers.replace_parquet(rejects, outputs.output_path(root, "silver_data_quality_rejects"))
    return outputs.ask(spark, root, triage.RULES_BY_NAME, dataset="transactions", places=5)


@query
def triage_summary(spark: SparkSession, folder: str) -> DataFrame:
    profile = profile_of(spark, folder)
    hits = hits_of(profile)
    rows = triage.with_top_rules(gold.data_quality_dashboard(audit_of(profile), hits), hits)
    text = triage.summary(F.col(triage.TOP_RULES)).alias("plain_language_summary")
    return rows.select("dataset_name", text)


@query
def triage_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return triage.ordered_dashboard(dashboard(spark, folder))


@query
def triage_table(spark: SparkSession, folder: str) -> DataFrame:
    return triage_frame(spark, folder)


@query
def governance_log(spark: SparkSession, folder: str) -> DataFrame:
    return triage.issue_log(triage_frame(spark, folder))


# --- reports -----------------------------------------------------------------


@query
def rpt_layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.layer_counts(spark, refreshed(spark, folder))


@query
def rpt_layer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.layer_summary(reports.layer_counts(spark, refreshed(spark, folder)))


@query
def rpt_kpis(spark: SparkSession, folder: str) -> DataFrame:
    out = refreshed(spark, folder)
    board = outputs.load_output(spark, out, "gold_data_quality_dashboard")
    risk = outputs.load_output(spark, out, "ml_customer_risk_features")
    return reports.kpis(reports.layer_counts(spark, out), board, risk)


@query
def rpt_dq_display(spark: SparkSession, folder: str) -> DataFrame:
    return reports.data_quality_display(dashboard(spark, folder))


@query
def rpt_rule_hits(spark: SparkSession, folder: str) -> DataFrame:
    return reports.rule_hits(dashboard(spark, folder))


@query
def rpt_triage_display(spark: SparkSession, folder: str) -> DataFrame:
    return reports.triage_display(triage_frame(spark, folder))


@query
def rpt_customer_sample(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_sample(customer_360(spark, folder))


@query
def rpt_segment_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = reports.segment_summary(customer_360(spark, folder))
    return rounded(summary, avg_transactions=4, avg_balance=2)


@query
def rpt_product_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.product_totals(products(spark, folder))


@query
def rpt_risk_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.risk_summary(feature_table(spark, folder))


@query
def rpt_activity_points(spark: SparkSession, folder: str) -> DataFrame:
    return reports.activity_points(feature_table(spark, folder))


@query
def rpt_feature_sample(spark: SparkSession, folder: str) -> DataFrame:
    return reports.feature_sample(feature_table(spark, folder))


# --- checks, gates and the whole refresh -------------------------------------


@query
def chk_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    return checks.null_keys(role(spark, folder, "fraud_alert_events"), "customer_id")


@query
def chk_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    expected = table(spark, folder, "customer").count()
    return checks.row_count_check(customer_360(spark, folder), "gold_customer_360", expected)


@query
def chk_point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return checks.lookup(
        dashboard(spark, folder), "transactions", "total_reject_rule_hits", "acceptance_rate"
    )


@query
def gate_report(spark: SparkSession, folder: str) -> DataFrame:
    gates = checks.quality_gates(
        *(standardized(spark, folder, name) for name in ("customers", "transactions", "accounts"))
    )
    return rounded(gates, measured=9)


@query
def gate_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """What the gates say about the whole run."""
    return checks.verdict(
        checks.quality_gates(
            *(standardized(spark, folder, n) for n in ("customers", "transactions", "accounts"))
        )
    )


@query
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return outputs.load_output(spark, refreshed(spark, folder), "gold_data_quality_dashboard")


def _refreshed_output(key: str, output: str) -> None:
    _QUERIES[key] = lambda spark, folder: outputs.load_output(
        spark, refreshed(spark, folder), output
    )


_refreshed_output("full_refresh_customer_360", "gold_customer_360")
_refreshed_output("full_refresh_daily_summary", "gold_daily_transaction_summary")
_refreshed_output("full_refresh_product_performance", "gold_product_performance")
_refreshed_output("full_refresh_features", "ml_customer_risk_features")
_refreshed_output("full_refresh_triage", "ai_pipeline_triage")
_refreshed_output("full_refresh_transform_audit", "silver_transform_audit")
_refreshed_output("full_refresh_load_audit", "bronze_load_audit")
_refreshed_output("full_refresh_issue_log", "governance_issue_log")


@query
def full_refresh_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The stored quarantine, with the key read back out of the payload."""
    stored = outputs.load_output(spark, refreshed(spark, folder), "silver_data_quality_rejects")
    keys = F.create_map(*[F.lit(x) for pair in KEYS.items() for x in pair])
    path = F.concat(F.lit("$."), F.element_at(keys, F.col("dataset_name")))
    key = F.expr("get_json_object(record_payload_json, path)")
    return stored.withColumn("path", path).withColumn("record_key", key).drop("path", "record_payload_json")
