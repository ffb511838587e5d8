"""Text cleaning expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The texts pandas reads as missing in a CSV file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


# The same characters as a SQL literal.
WHITESPACE_SQL = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "'"
_NA_SQL = ", ".join(f"'{token}'" for token in NA_TOKENS)


def quoted(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


# The expressions below are SQL text, one call per column: with hundreds of
# columns, building them function by function costs more than small jobs take.


def stripped_sql(sql: str) -> str:
    """One call, whatever the text: tests that spare it for plain texts take more code than they save time.

    With them a dataset's projection grew past the 8,000 bytes of code that the JVM compiles of one method.
    """
    return f"btrim({sql}, {WHITESPACE_SQL})"


def strip(name: str) -> Column:
    """Remove leading and trailing whitespace, tabs and line breaks included.

    Spark's one-argument ``trim`` removes blanks only.
    """
    return F.expr(stripped_sql(quoted(name)))


def fold_case(name: str) -> Column:
    """Stripped and lower-cased."""
    return F.expr(f"lower({stripped_sql(quoted(name))})")


def is_blank(name: str, *, stripped: bool = False) -> Column:
    """True for null and for text that is empty after stripping; never null."""
    column = quoted(name)
    return F.expr(f"{column} IS NULL OR {column if stripped else stripped_sql(column)} = ''")


def null_if_na(name: str) -> Column:
    """Null for the missing-value tokens of a CSV file, else the text unchanged."""
    column = quoted(name)
    return F.expr(f"CASE WHEN {column} NOT IN ({_NA_SQL}) THEN {column} END")
