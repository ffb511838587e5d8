"""Where each output table lies below the output folder, and how to load it."""

from __future__ import annotations

from string import Formatter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from oreflow.operators.bronze import METADATA
from oreflow.operators.standardize import standardize
from oreflow.registry import DATASETS, SOURCES
from oreflow.sources.versions import current_root

# Rows of a checked dataset are stored by outcome: rows that passed, rows no
# rule could decide on, and rows that broke a rule. The broken rules are a column.
OUTCOME = "rule_outcome"
PASSED, UNDECIDED, BROKEN = "passed", "undecided", "broken"
BROKEN_RULES = "broken_rules"

TRIAGE_SCHEMA = StructType(
    [
        StructField("issue_id", StringType()),
        StructField("dataset_name", StringType()),
        StructField("bronze_table", StringType()),
        StructField("silver_table", StringType()),
        StructField("acceptance_rate", DoubleType()),
        StructField("critical_reject_rule_hits", LongType()),
        StructField("high_reject_rule_hits", LongType()),
        StructField("medium_reject_rule_hits", LongType()),
        StructField("total_reject_rule_hits", LongType()),
        StructField("top_failed_rules", StringType()),
        StructField("priority", StringType()),
        StructField("triage_status", StringType()),
        StructField("recommended_owner", StringType()),
        StructField("plain_language_summary", StringType()),
        StructField("recommended_action", StringType()),
        StructField("created_at_utc", StringType()),
    ]
)

_GOLD = (
    "gold_customer_360",
    "gold_daily_transaction_summary",
    "gold_product_performance",
    "gold_data_quality_dashboard",
)

# Layer -> output table -> path below the output folder. These are the tables
# the row-count report covers.
LAYERS: dict[str, dict[str, str]] = {
    "bronze": {d.bronze_table: f"bronze/{d.bronze_table}.parquet" for d in DATASETS.values()},
    "silver": {d.silver_table: f"silver/{d.silver_table}.parquet" for d in DATASETS.values()},
    "gold": {name: f"gold/{name}.parquet" for name in _GOLD},
    "ml_features": {
        "ml_customer_risk_features": "ml_features/ml_customer_risk_features.parquet"
    },
    "ai_automation": {"ai_pipeline_triage": "metadata/ai_pipeline_triage.csv"},
}

# Further tables a refresh writes.
CONTROL: dict[str, str] = {
    "bronze_load_audit": "bronze/bronze_load_audit.parquet",
    "silver_data_quality_rejects": "silver/silver_data_quality_rejects.parquet",
    "silver_transform_audit": "silver/silver_transform_audit.parquet",
    "ai_pipeline_triage_parquet": "metadata/ai_pipeline_triage.parquet",
    "governance_issue_log": "metadata/governance_issue_log.csv",
    "quality_gates": "metadata/quality_gates.parquet",
}

# Tables about a run that must be readable when it stops: not part of a version.
OUTSIDE_VERSIONS = {"quality_gates"}

PATHS: dict[str, str] = {
    name: path for tables in LAYERS.values() for name, path in tables.items()
} | CONTROL


def output_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{PATHS[table]}"


def silver_schema(spark: SparkSession, dataset: str) -> StructType:
    """Columns of a silver table, known without any stored file."""
    bronze = [*SOURCES[dataset].schema.fields, *[StructField(n, StringType()) for n in METADATA]]
    empty = spark.createDataFrame([], StructType(bronze))
    return standardize(empty, "").schema


def read_checked(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """All rows of a checked dataset; filters on the outcome prune folders.

    With its schema given the dataset can be read where an outcome, or all, have no row.
    """
    kinds = [StructField(BROKEN_RULES, StringType()), StructField(OUTCOME, StringType())]
    return spark.read.schema(StructType([*columns.fields, *kinds])).parquet(path)


def passed_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(OUTCOME) == PASSED).drop(OUTCOME, BROKEN_RULES)


def load_file(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Load a stored table by the suffix of its path."""
    name = path.rstrip("/")
    if name.endswith(".parquet"):
        return spark.read.parquet(path)
    if name.endswith(".csv"):
        reader = (
            spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST")
        )
        return (reader.schema(schema) if schema else reader).csv(path)
    raise ValueError(f"unsupported output type: {path}")


def load_output(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Load an output table by name; raises FileNotFoundError where it is missing.

    The table is that of the version in use, or lies below ``root`` itself where there are no versions.
    """
    path = output_path(root if table in OUTSIDE_VERSIONS else current_root(spark, root), table)
    dataset = table.removeprefix("silver_")
    try:
        if table in LAYERS["silver"]:
            return passed_rows(read_checked(spark, path, silver_schema(spark, dataset)))
        return load_file(spark, path, TRIAGE_SCHEMA if table == "ai_pipeline_triage" else None)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no output {table} at {path}; run the refresh first") from error
        raise


def ask(spark: SparkSession, root: str, query: str, **values: object) -> DataFrame:
    """Run SQL over output tables named in braces, with ``:name`` markers for values.

    Values are bound as parameters, never pasted into the text, so quotes in them are harmless::

        ask(spark, root, "SELECT * FROM {gold_customer_360} WHERE customer_id = :id", id="C'1")
    """
    named = {name for _, name, _, _ in Formatter().parse(query) if name}
    tables = {name: load_output(spark, root, name) for name in named}
    return spark.sql(query, args=values, **tables)
