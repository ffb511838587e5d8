"""Timestamp expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreflow.functions.text import quoted


def ntz_sql(value: str) -> str:
    """`to_ntz` of a SQL expression."""
    signs = " OR ".join(f"substr({value}, -{n}, 1) IN ('+', '-')" for n in (3, 5, 6))
    zoned = f"length({value}) > 12 AND (substr({value}, -1) NOT BETWEEN '0' AND '9' OR {signs})"
    moment = f"CAST(try_cast({value} AS TIMESTAMP) AS TIMESTAMP_NTZ)"
    return (
        f"CASE WHEN {zoned} AND {value} RLIKE '[0-9] ?(Z|[A-Z][A-Za-z/_]+|(UTC|GMT)?[+-][0-9:]+)$'"
        f" THEN convert_timezone(current_timezone(), 'UTC', {moment})"
        f" ELSE try_cast({value} AS TIMESTAMP_NTZ) END"
    )


def to_ntz(name: str) -> Column:
    """Zone-less timestamp, or null where the value cannot be read as one.

    A value that names a zone is taken to UTC, so that the same moment is the
    same value; others stay as written. Only values longer than a date that end
    in a letter or have a sign near their end are looked at for a zone.
    """
    return F.expr(ntz_sql(quoted(name)))


def to_boolean(name: str) -> Column:
    return F.expr(f"try_cast({quoted(name)} AS BOOLEAN)")
