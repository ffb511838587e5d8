"""Rule-based validation: valid rows, reject records and the transform audit."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from oreflow.functions import is_blank, quoted
from oreflow.model import CRITICAL, DatasetSpec
from oreflow.operators.uniqueness import PLACE, mark_repeated

RULE_HITS = "_rule_hits"  # names of the violated rules, joined by a comma
ROW_VALID = "_row_valid"  # true, false, or null where no rule could decide
_REPEATED = "_key_repeated"

REJECT_SCHEMA = StructType(
    [
        StructField("dataset_name", StringType()),
        StructField("rule_name", StringType()),
        StructField("severity", StringType()),
        StructField("rejected_at_utc", StringType()),
        StructField("record_payload_json", StringType()),
    ]
)

AUDIT_SCHEMA = StructType(
    [
        StructField("dataset_name", StringType()),
        StructField("bronze_table", StringType()),
        StructField("silver_table", StringType()),
        StructField("bronze_row_count", LongType()),
        StructField("silver_row_count", LongType()),
        StructField("rejected_rule_hits", LongType()),
        StructField("processed_at_utc", StringType()),
        StructField("status", StringType()),
    ]
)

_JSON_OPTIONS = {"ignoreNullFields": "false"}
_MOMENTS = (TimestampNTZType, TimestampType)


def required_rule(column: str) -> str:
    return f"{column}_required"


def unique_rule(column: str) -> str:
    return f"{column}_must_be_unique"


def severities(spec: DatasetSpec) -> dict[str, str]:
    """Rule name -> severity, for every rule the dataset can break."""
    found = {required_rule(column): CRITICAL for column in spec.required}
    if spec.unique_key:
        found[unique_rule(spec.unique_key)] = CRITICAL
    return found | {rule.name: rule.severity for rule in spec.rules}


def flag_rules(
    df: DataFrame,
    spec: DatasetSpec,
    *,
    strict_nulls: bool = False,
    stripped: bool = False,
    **uniqueness: int,
) -> DataFrame:
    """Append the violated rules and the verdict of each row, in one pass.

    Rules on columns the dataset lacks are skipped. A mask may be null (a
    missing currency is neither right nor wrong): such a row breaks no rule,
    yet is not valid either and leaves silver without a reject record.
    ``strict_nulls`` counts an undecided rule as broken instead; ``stripped``
    says that text is free of outer whitespace already, as after
    standardisation. A place from `with_place` helps to compare keys and is taken off.
    """
    names = [name for name in df.columns if name != PLACE]
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    masks: list[tuple[str, Column]] = [
        (
            required_rule(column),
            is_blank(column, stripped=stripped)
            if column in text
            else F.col(quoted(column)).isNull(),
        )
        for column in spec.required
        if column in names
    ]
    if spec.unique_key and spec.unique_key in names:
        df = mark_repeated(df, spec.unique_key, _REPEATED, **uniqueness)
        masks.append((unique_rule(spec.unique_key), F.col(_REPEATED)))
    masks += [
        (rule.name, rule.violated(F.col(f"`{rule.column}`")))
        for rule in spec.rules
        if rule.column in names
    ]
    if strict_nulls:
        masks = [(name, F.coalesce(mask, F.lit(True))) for name, mask in masks]
    data = [F.col(f"`{name}`") for name in names]
    # Always true, but not to the optimizer: it keeps filters on the two results
    # above this projection. Pushed below, they would clean and parse each value
    # again for every time a rule mentions it.
    here = F.spark_partition_id() >= 0
    hits = F.when(here, F.concat_ws(",", *[F.when(mask, F.lit(name)) for name, mask in masks]))
    verdict = here & ~reduce(or_, (mask for _, mask in masks), F.lit(False))
    return df.select(*data, hits.alias(RULE_HITS), verdict.alias(ROW_VALID))


def data_columns(flagged: DataFrame) -> list[str]:
    return [name for name in flagged.columns if name not in (RULE_HITS, ROW_VALID)]


def valid_rows(flagged: DataFrame) -> DataFrame:
    """Rows that break no rule for certain."""
    return flagged.filter(F.col(ROW_VALID)).drop(RULE_HITS, ROW_VALID)


def reject_records(
    flagged: DataFrame, spec: DatasetSpec, rejected_at: str, *, payload: Sequence[str] | None = None
) -> DataFrame:
    """One record per broken rule, with the whole row as JSON.

    A broken row is rendered once; its text alone is multiplied by the rules.
    """
    columns = payload if payload is not None else data_columns(flagged)

    def shown(name: str) -> Column:
        """Moments as plain text: a blank before the time, fractions of a second where there are any."""
        value = F.col(f"`{name}`")
        is_moment = isinstance(flagged.schema[name].dataType, _MOMENTS)
        return (value.cast("string") if is_moment else value).alias(name)

    severity = F.create_map(*[F.lit(text) for pair in severities(spec).items() for text in pair])
    return (
        flagged.filter(F.col(RULE_HITS) != "")
        .select(
            F.to_json(F.struct(*[shown(c) for c in columns]), _JSON_OPTIONS).alias(
                "record_payload_json"
            ),
            RULE_HITS,
        )
        .select("record_payload_json", F.explode(F.split(RULE_HITS, ",")).alias("rule_name"))
        .select(
            F.lit(spec.name).alias("dataset_name"),
            "rule_name",
            F.element_at(severity, F.col("rule_name")).alias("severity"),
            F.lit(rejected_at).alias("rejected_at_utc"),
            "record_payload_json",
        )
    )


def parsed_payload(rejects: DataFrame, schema: StructType) -> DataFrame:
    """Reject records with the rejected row read back from its JSON text."""
    read = StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, _MOMENTS) else f.dataType)
            for f in schema
        ]
    )
    row = F.from_json("record_payload_json", read).alias("row")
    return rejects.select("dataset_name", "rule_name", "severity", row).select(
        "dataset_name",
        "rule_name",
        "severity",
        *[F.col(f"row.`{f.name}`").cast(f.dataType).alias(f.name) for f in schema],
    )


def rule_profile(flagged: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows by verdict and set of broken rules: all that audit, dashboard and top rules count.

    Combined before the shuffle; there are at most 2 ** rules sets.
    """
    counts = flagged.groupBy(RULE_HITS, ROW_VALID).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(
        F.lit(spec.name).alias("dataset_name"),
        F.col(RULE_HITS).alias("broken"),
        F.col(ROW_VALID).alias("valid"),
        "rows",
    )


def profile_audit(
    profile: DataFrame, specs: Iterable[DatasetSpec], processed_at: str
) -> DataFrame:
    """The transform audit from the profiles of several datasets, those without rows included."""
    named = [(spec.name, spec.bronze_table, spec.silver_table) for spec in specs]
    listed = profile.sparkSession.createDataFrame(
        named, "dataset_name string, bronze_table string, silver_table string"
    )
    hits = F.when(F.col("broken") == "", 0).otherwise(F.size(F.split("broken", ",")))
    counts = profile.groupBy("dataset_name").agg(
        F.sum("rows").alias("bronze_row_count"),
        F.sum(F.when(F.col("valid"), F.col("rows")).otherwise(0)).alias("silver_row_count"),
        F.sum(hits * F.col("rows")).alias("rejected_rule_hits"),
    )
    names = ("bronze_row_count", "silver_row_count", "rejected_rule_hits")
    return listed.join(counts, "dataset_name", "left").select(
        "dataset_name",
        "bronze_table",
        "silver_table",
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in names],
        F.lit(processed_at).alias("processed_at_utc"),
        F.lit("success").alias("status"),
    )


def profile_hits(profile: DataFrame, specs: Iterable[DatasetSpec]) -> DataFrame:
    """dataset_name, rule_name, severity and rule_hits of every broken rule."""
    texts = [
        F.lit(text)
        for spec in specs
        for rule, severity in severities(spec).items()
        for text in (f"{spec.name}.{rule}", severity)
    ]
    rules = profile.filter(F.col("broken") != "").select(
        "dataset_name", F.explode(F.split("broken", ",")).alias("rule_name"), "rows"
    )
    counts = rules.groupBy("dataset_name", "rule_name").agg(F.sum("rows").alias("rule_hits"))
    key = F.concat_ws(".", "dataset_name", "rule_name")
    severity = F.element_at(F.create_map(*texts), key).alias("severity")
    return counts.select("dataset_name", "rule_name", severity, "rule_hits")


def union_rejects(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """All reject records; an empty typed frame when there are none."""
    if not frames:
        return spark.createDataFrame([], REJECT_SCHEMA)
    return reduce(DataFrame.unionByName, frames)


def transform_audit(flagged: DataFrame, spec: DatasetSpec, processed_at: str) -> DataFrame:
    """Rows in, rows accepted and rule hits of one dataset, from a single aggregate."""
    hits = F.when(F.col(RULE_HITS) == "", 0).otherwise(F.size(F.split(RULE_HITS, ",")))
    counts = flagged.agg(
        F.count(F.lit(1)).alias("bronze_row_count"),
        F.count_if(ROW_VALID).alias("silver_row_count"),
        F.coalesce(F.sum(hits), F.lit(0)).cast("bigint").alias("rejected_rule_hits"),
    )
    return counts.select(
        F.lit(spec.name).alias("dataset_name"),
        F.lit(spec.bronze_table).alias("bronze_table"),
        F.lit(spec.silver_table).alias("silver_table"),
        "*",
        F.lit(processed_at).alias("processed_at_utc"),
        F.lit("success").alias("status"),
    )


def audit_table(spark: SparkSession, records: Iterable[dict]) -> DataFrame:
    """One row per dataset from counts taken elsewhere."""
    rows = [tuple(record[name] for name in AUDIT_SCHEMA.names) for record in records]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)
