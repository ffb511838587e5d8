"""The full refresh: raw files -> bronze -> silver -> gold and features -> triage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.model import DatasetSpec, SourceSpec
from oreflow.operators import bronze, checks, features, gold, quality, standardize, triage
from oreflow.operators.uniqueness import with_place
from oreflow.registry import DATASETS, SOURCES
from oreflow.session import refresh_settings, scratch_scope
from oreflow.sources.outputs import (
    BROKEN,
    BROKEN_RULES,
    LAYERS,
    OUTCOME,
    PASSED,
    PATHS,
    UNDECIDED,
    load_output,
    output_path,
    passed_rows,
    read_checked,
    silver_schema,
)
from oreflow.sources.readers import read_raw
from oreflow.sources.versions import Run, current_root, fingerprint, publish
from oreflow.sources.writers import COMPRESSION, point_table, replace_csv, replace_parquet

# Up to so many records of a dataset are dealt out anew to be written, more are written where they are read.
FEW_REJECTS = 100_000

T = TypeVar("T")
R = TypeVar("R")
# Does a named step, or tells its record where it has been done before.
Once = Callable[[str, Callable[[], dict | None]], dict | None]


def _always(step: str, work: Callable[[], dict | None]) -> dict | None:
    return work()


def _each(spark: SparkSession, step: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """Run independent jobs side by side, so that small ones fill idle executors.

    The first failure is raised once the running jobs have ended.
    """
    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(inheritable_thread_target(spark)(step), items))


def refresh_bronze(
    spark: SparkSession, raw: str, out: str, *, run_ts: str, load_id: str, once: Once = _always
) -> None:
    """Load every registered source and write the load audit."""

    def load(spec: SourceSpec) -> dict:
        table = DATASETS[spec.name].bronze_table
        path = output_path(out, table)
        df = bronze.to_bronze(
            read_raw(spark, spec, raw, with_file=True),
            load_id=load_id,
            ingested_at=run_ts,
            source_system=spec.source_system,
        )
        replace_parquet(df, path)
        # Counted from the footers of what was stored: right after retries too.
        return {
            "bronze_load_id": load_id,
            "dataset_name": spec.name,
            "source_file": spec.file_name,
            "source_system": spec.source_system,
            "file_format": spec.file_format,
            "row_count": spark.read.schema(df.schema).parquet(path).count(),
            "column_count": len(df.columns),
            "loaded_at_utc": run_ts,
            "status": "success",
        }

    def noted(spec: SourceSpec) -> dict:
        return once(f"bronze-{spec.name}", partial(load, spec))

    def audit() -> None:
        records = bronze.load_audit(spark, loads)
        replace_parquet(records.coalesce(1), output_path(out, "bronze_load_audit"))

    loads = _each(spark, noted, SOURCES.values())
    once("bronze-audit", audit)


def write_checked(flagged: DataFrame, path: str) -> None:
    """Store a flagged dataset once, by outcome, with the broken rules as a column.

    One pass yields the silver table, the quarantine and their counts, in at
    most three files a task. Everything of an earlier run goes, whatever the
    session says about overwriting partitions.
    """
    outcome = (
        F.when(F.col(quality.ROW_VALID), PASSED)
        .when(F.col(quality.RULE_HITS) == "", UNDECIDED)
        .otherwise(BROKEN)
    )
    hits = F.col(quality.RULE_HITS).alias(BROKEN_RULES)
    (
        flagged.select(*quality.data_columns(flagged), hits, outcome.alias(OUTCOME))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", COMPRESSION)
        .partitionBy(OUTCOME)
        .parquet(path)
    )


def stored_rejects(checked: DataFrame, spec: DatasetSpec, rejected_at: str) -> DataFrame:
    """Reject records from the quarantine folder alone."""
    broken = checked.filter(F.col(OUTCOME) == BROKEN)
    payload = [name for name in checked.columns if name not in (OUTCOME, BROKEN_RULES)]
    return quality.reject_records(
        broken.withColumnRenamed(BROKEN_RULES, quality.RULE_HITS), spec, rejected_at, payload=payload
    )


def stored_audit(checked: DataFrame, spec: DatasetSpec, processed_at: str) -> dict:
    """Audit record of a stored dataset, from its outcome and rule columns; one row is collected."""
    hits = F.when(F.col(BROKEN_RULES) != "", F.size(F.split(BROKEN_RULES, ","))).otherwise(0)
    counts = checked.agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(F.col(OUTCOME) == PASSED).alias("passed"),
        F.coalesce(F.sum(hits), F.lit(0)).alias("hits"),
    ).first()
    return {
        "dataset_name": spec.name,
        "bronze_table": spec.bronze_table,
        "silver_table": spec.silver_table,
        "bronze_row_count": counts["all"],
        "silver_row_count": counts["passed"],
        "rejected_rule_hits": counts["hits"],
        "processed_at_utc": processed_at,
        "status": "success",
    }


def refresh_silver(
    spark: SparkSession,
    out: str,
    *,
    run_ts: str,
    strict_nulls: bool = False,
    date_layouts: bool = False,
    once: Once = _always,
) -> dict[str, DataFrame]:
    """Standardise and validate every bronze table; returns the silver tables by dataset."""

    def stored_rows(spec: DatasetSpec) -> DataFrame:
        columns = silver_schema(spark, spec.name)
        return read_checked(spark, output_path(out, spec.silver_table), columns)

    def check(spec: DatasetSpec) -> dict:
        stored = load_output(spark, out, spec.bronze_table)
        layouts = standardize.date_layouts(stored) if date_layouts else None
        rows = standardize.standardize(with_place(stored), run_ts, layouts)
        path = output_path(out, spec.silver_table)
        flagged = quality.flag_rules(rows, spec, strict_nulls=strict_nulls, stripped=True)
        write_checked(flagged, path)
        return stored_audit(stored_rows(spec), spec, run_ts)

    def noted(spec: DatasetSpec) -> dict:
        return once(f"silver-{spec.name}", partial(check, spec))

    def audit() -> None:
        table = quality.audit_table(spark, records)
        replace_parquet(table.coalesce(1), output_path(out, "silver_transform_audit"))

    def quarantine() -> None:
        # A scan of the broken rows deals very many evenly by itself, and their texts are the widest rows of
        # a refresh. A few, from however many files, share files. Dealt by payload: to deal in turn,
        # Spark would sort the wide records first, so that retries deal alike.
        few, many = [], []
        for spec, record in zip(specs, records, strict=True):
            if hits := record["rejected_rule_hits"]:
                part = stored_rejects(stored_rows(spec), spec, run_ts)
                (few if hits <= FEW_REJECTS else many).append(part)
        even = quality.union_rejects(spark, few).hint("rebalance", "record_payload_json")
        rejects = quality.union_rejects(spark, [even, *many] if few or not many else many)
        replace_parquet(rejects, output_path(out, "silver_data_quality_rejects"))

    specs = list(DATASETS.values())
    records = _each(spark, noted, specs)
    once("silver-audit", audit)
    once("silver-rejects", quarantine)
    return {spec.name: passed_rows(stored_rows(spec)) for spec in specs}


def refresh_gold(
    spark: SparkSession, out: str, silver: dict[str, DataFrame], *, once: Once = _always
) -> None:
    """Build the marts and, from the stored customer 360, the feature table.

    Validation left account ids unique, which spares a distinct count.
    """

    def customers() -> None:
        mart = gold.customer_360(
            silver["customers"],
            silver["accounts"],
            silver["transactions"],
            silver["fraud_alert_events"],
            silver["customer_service_notes"],
            unique_accounts=True,
        )
        replace_parquet(mart, output_path(out, "gold_customer_360"))

    def risk_features() -> None:
        stored = load_output(spark, out, "gold_customer_360")
        replace_parquet(
            features.customer_risk_features(stored), output_path(out, "ml_customer_risk_features")
        )

    def customer_tables() -> None:
        once("gold-customers", customers)
        once("ml-features", risk_features)

    def daily() -> None:
        replace_parquet(
            gold.daily_transaction_summary(silver["transactions"]),
            output_path(out, "gold_daily_transaction_summary"),
        )

    def products() -> None:
        replace_parquet(
            gold.product_performance(
                silver["products"],
                silver["accounts"],
                silver["transactions"],
                unique_accounts=True,
            ),
            output_path(out, "gold_product_performance"),
        )

    def dashboard() -> None:
        replace_parquet(
            gold.data_quality_dashboard(
                load_output(spark, out, "silver_transform_audit"),
                load_output(spark, out, "silver_data_quality_rejects"),
            ),
            output_path(out, "gold_data_quality_dashboard"),
        )

    steps = {"gold-daily": daily, "gold-products": products, "gold-dashboard": dashboard}
    builds = [customer_tables, *[partial(once, name, step) for name, step in steps.items()]]
    _each(spark, lambda build: build(), builds)


def refresh_triage(spark: SparkSession, out: str, *, run_ts: str, once: Once = _always) -> None:
    """Triage the stored dashboard. Both reports hold one row per dataset."""
    report = output_path(out, "ai_pipeline_triage_parquet")

    def table() -> None:
        rows = triage.triage_table(
            load_output(spark, out, "gold_data_quality_dashboard"),
            load_output(spark, out, "silver_data_quality_rejects"),
            run_ts,
        )
        replace_parquet(rows.coalesce(1), report)

    def texts() -> None:
        stored = spark.read.parquet(report)
        replace_csv(stored, output_path(out, "ai_pipeline_triage"), single_file=True)
        replace_csv(
            triage.issue_log(stored), output_path(out, "governance_issue_log"), single_file=True
        )

    once("triage-table", table)
    once("triage-texts", texts)


def register(spark: SparkSession, out: str, database: str) -> None:
    """Point the tables of a database at the stored outputs, one table for each.

    No data is read or copied. A silver table is a view of the passed rows over
    a table of all checked rows, which is named ``<table>_checked``.
    """
    root = current_root(spark, out)

    def show(name: str) -> None:
        table, path = f"{database}.{name}", output_path(root, name)
        frame = load_output(spark, root, name)
        if name in LAYERS["silver"]:
            columns = silver_schema(spark, name.removeprefix("silver_"))
            point_table(spark, f"{table}_checked", path, read_checked(spark, path, columns).schema)
            if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
                spark.sql(f"DROP TABLE {table}")
            listed = ", ".join(f"`{column}`" for column in frame.columns)
            spark.sql(
                f"CREATE OR REPLACE VIEW {table} AS SELECT {listed} FROM {table}_checked "
                f"WHERE {OUTCOME} = '{PASSED}'"
            )
        elif path.endswith(".csv"):
            point_table(spark, table, path, frame.schema, "csv", header="true", escape='"')
        else:
            point_table(spark, table, path, frame.schema)

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    optional = {"quality_gates", "ai_pipeline_triage_parquet"}
    _each(spark, show, [name for name in PATHS if name not in optional])


def refresh(
    spark: SparkSession,
    raw: str,
    out: str,
    *,
    run_ts: str | None = None,
    load_id: str | None = None,
    strict_nulls: bool = False,
    date_layouts: bool = False,
    limits: checks.QualityLimits | None = None,
    database: str | None = None,
    resume: bool = False,
    keep: int = 2,
) -> None:
    """Rebuild every table from the files below ``raw``, as a new version below ``out``.

    Readers see the version before until every step has ended; then one pointer
    file turns them all to the new one, and ``keep`` versions stay. A failing step stops the run and
    changes nothing for readers. With ``resume`` the last unfinished run over the same files,
    settings and code goes on after the steps it has ended, with its run time and load id where
    none are given; the caller sees to it that nothing else works on that run.

    Run time (UTC) and load id are made once where none are given. With ``limits``
    the gates are measured on bronze after loading and, where asked for, stop the run on a breach;
    their table is outside the versions, so it tells why a run stopped. With
    ``database`` the tables can be queried by name afterwards. With ``date_layouts`` dates may come
    in the layouts people write; day and month are told apart by each column. Scratch data of the
    run is deleted at its end.
    """
    settings = {
        "run_ts": run_ts,
        "load_id": load_id,
        "strict_nulls": strict_nulls,
        "date_layouts": date_layouts,
        "limits": repr(limits),
    }
    told = fingerprint(spark, raw, settings)
    run = Run.unfinished(spark, out, told) if resume else None
    if run is None:
        made = {
            "run_ts": run_ts or datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S"),
            "load_id": load_id or str(uuid.uuid4()),
        }
        run = Run.start(spark, out, {"fingerprint": told, **made})
    run_ts, load_id, once, place = run.facts["run_ts"], run.facts["load_id"], run.once, run.path

    def gates() -> None:
        rows = {
            name: standardize.standardize(load_output(spark, place, f"bronze_{name}"), run_ts)
            for name in ("customers", "transactions", "accounts")
        }
        measured = checks.quality_gates(**rows, limits=limits)
        replace_parquet(measured.coalesce(1), output_path(out, "quality_gates"))
        checks.enforce(load_output(spark, out, "quality_gates"), limits)

    try:
        with refresh_settings(spark), scratch_scope(spark):
            refresh_bronze(spark, raw, place, run_ts=run_ts, load_id=load_id, once=once)
            if limits is not None:
                once("gates", gates)
            options = {"strict_nulls": strict_nulls, "date_layouts": date_layouts}
            silver = refresh_silver(spark, place, run_ts=run_ts, once=once, **options)
            refresh_gold(spark, place, silver, once=once)
            refresh_triage(spark, place, run_ts=run_ts, once=once)
    except BaseException:
        run.failed()
        raise
    publish(spark, out, run.version, keep)
    if database is not None:
        register(spark, out, database)
