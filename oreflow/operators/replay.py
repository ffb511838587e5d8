"""Quarantined rows: looked up by path and checked again."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.model import DatasetSpec
from oreflow.operators.quality import flag_rules
from oreflow.operators.standardize import standardize
from oreflow.operators.uniqueness import with_place
from oreflow.session import refresh_settings, staged
from oreflow.sources.writers import COMPRESSION

# Made by the standardisation, so made anew.
_MADE = ("transaction_date", "_silver_processed_at_utc")


def with_record(rejects: DataFrame) -> DataFrame:
    """Reject records with the row as one ``record`` variant in place of its text.

    The text is parsed once; every question after that is a look-up in the variant.
    """
    record = F.parse_json("record_payload_json").alias("record")
    return rejects.select(*[c for c in rejects.columns if c != "record_payload_json"], record)


def field(column: str, kind: str = "string") -> Column:
    """A column of the rejected row; null where it is missing or not of this kind."""
    quoted = column.replace("\\", "\\\\").replace('"', '\\"')
    return F.try_variant_get("record", f'$["{quoted}"]', kind)


def replay(
    rejects: DataFrame,
    spec: DatasetSpec,
    silver: DataFrame,
    run_ts: str,
    *,
    settled: Iterable[str],
    strict_nulls: bool = False,
) -> DataFrame:
    """Standardise and check again the rejected rows that broke no other rules than ``settled``.

    A row stands once, however many of its records there are and however often it was delivered.
    Keys are compared among the replayed rows and with ``silver``: a key that silver holds by now is
    left out. The result is flagged as `flag_rules` does it, so `valid_rows` gives
    what can be added to silver; null keys stay and break their rule again.

    The rows to check are stored first: comparing their keys reads them twice, and each time all that
    leads to them would be shuffled again.
    """
    allowed = F.array(*[F.lit(rule) for rule in settled])
    own = rejects.filter(F.col("dataset_name") == spec.name)
    rows = own.groupBy("record_payload_json").agg(F.bool_and(F.array_contains(allowed, F.col("rule_name"))).alias("settled"))
    columns = [c for c in silver.columns if c not in _MADE]
    rows = with_record(rows.filter("settled")).select(*[field(c).alias(c) for c in columns])
    again = standardize(rows, run_ts)
    if spec.unique_key:
        again = again.join(silver.select(spec.unique_key), spec.unique_key, "left_anti").select(again.columns)
    with refresh_settings(rejects.sparkSession):
        stored = staged(again, "replayed", compression=COMPRESSION)
        return flag_rules(with_place(stored), spec, strict_nulls=strict_nulls, stripped=True)
