"""Layouts of written dates: settled per column from counts of its values, reported where they are ambiguous.

Spark counts, for each column, the kinds of layout its values have (a fixed list, so a few rows
whatever the column holds) and how many have a first or second field over 12, which tells day from
month. Counts of several loads add up. The settled layouts become one list of patterns for the
column, which rewrite a value to what Spark's cast reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.text import WHITESPACE_SQL, quoted, stripped_sql
from oreflow.functions.times import ntz_sql

DAY_FIRST, MONTH_FIRST = "day_first", "month_first"
#: Some values can only be read day first, others only month first.
MIXED = "mixed"
#: Nothing in the column tells day from month.
AMBIGUOUS = "ambiguous"

# English names of the months, by the letters they may go on with.
MONTHS = (
    "jan(uary)?", "feb(ruary)?", "mar(ch)?", "apr(il)?", "may", "june?",
    "july?", "aug(ust)?", "sep(t|tember)?", "oct(ober)?", "nov(ember)?", "dec(ember)?",
)

#: Layouts that say themselves what each field is: name and start of the text.
PLAIN = {
    "year-dash": "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}",
    "year/slash": "[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}",
    "year.dot": "[0-9]{4}[.][0-9]{1,2}[.][0-9]{1,2}",
    "digits": "[0-9]{8}",
    "day name": "[0-9]{1,2}[ -][A-Za-z]{3,9}[ -][0-9]{4}",
    "name day": "[A-Za-z]{3,9} [0-9]{1,2},? [0-9]{4}",
}
#: Layouts whose first two fields are day and month in either order, by the mark between them.
SHORT = {f"short{mark}": mark for mark in "/.-"}

_CLOCK = "([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?"
_HALF_DAY = " [0-9]{1,2}:[0-9]{2}(:[0-9]{2})? ?[AaPp][Mm]"
_STARTS = PLAIN | {kind: f"[0-9]{{1,2}}[{mark}][0-9]{{1,2}}[{mark}][0-9]{{4}}" for kind, mark in SHORT.items()}
_NAMED = {"day name", "name day"}

# What each layout is rewritten to, so that Spark's cast reads it. A month's name is a marked number by then.
_REWRITTEN = {
    "year/slash": (("^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})", "$1-$2-$3"),),
    "year.dot": (("^([0-9]{4})[.]([0-9]{1,2})[.]([0-9]{1,2})", "$1-$2-$3"),),
    "digits": (("^([0-9]{4})([0-9]{2})([0-9]{2})(?=$|[ T])", "$1-$2-$3"),),
    "day name": (("^([0-9]{1,2})[ -]#([0-9]{2})[ -]([0-9]{4})", "$3-$2-$1"),),
    "name day": (("^#([0-9]{2}) ([0-9]{1,2}),? ([0-9]{4})", "$3-$1-$2"),),
}


def _short_rules(mark: str, order: str) -> tuple[tuple[str, str], ...]:
    """Rewriting of day and month in the order of a column, or only where one order is possible."""
    day, month, year = "([0-9]{1,2})", "([0-9]{1,2})", "([0-9]{4})"
    if order == DAY_FIRST:
        return ((f"^{day}[{mark}]{month}[{mark}]{year}", "$3-$2-$1"),)
    if order == MONTH_FIRST:
        return ((f"^{month}[{mark}]{day}[{mark}]{year}", "$3-$1-$2"),)
    late = "(1[3-9]|2[0-9]|3[01])"
    return (
        (f"^{late}[{mark}]{month}[{mark}]{year}", "$3-$2-$1"),
        (f"^{month}[{mark}]{late}[{mark}]{year}", "$3-$1-$2"),
        (f"^0?([1-9]|1[0-2])[{mark}]0?\\\\1[{mark}]{year}", "$2-$1-$1"),
    )


def _fits(text: str, start: str) -> str:
    return f"{text} RLIKE '^{start}({_CLOCK}|{_HALF_DAY})$'"


def _field(text: str, which: int) -> str:
    return f"CAST(regexp_extract({text}, '^([0-9]{{1,2}})[-/.]([0-9]{{1,2}})', {which}) AS INT)"


def _kind(text: str) -> str:
    cases = " ".join(f"WHEN {_fits(text, start)} THEN '{name}'" for name, start in _STARTS.items())
    return f"CASE {cases} WHEN {ntz_sql(text)} IS NOT NULL THEN 'standard' ELSE 'other' END"


COUNTED = ("values", "first_over_12", "second_over_12")


def count_layouts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """column_name, layout, values, first_over_12 and second_over_12 of the texts of some columns.

    One scan, combined before the shuffle. Null and blank values do not count. `layout` is a name of
    PLAIN or SHORT, `standard` for what else Spark's own cast reads, or `other`.
    """
    cells = [
        F.expr(f"named_struct('column_name', '{name}', 'text', {stripped_sql(quoted(name))})")
        for name in names
    ]
    texts = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter("text <> ''")
    kinds = texts.select("column_name", "text", F.expr(_kind("text")).alias("layout"))
    short = F.col("layout").isin(list(SHORT))

    def over(which: int) -> Column:
        return F.count_if(F.when(short, F.expr(_field("text", which)) > 12))

    return kinds.groupBy("column_name", "layout").agg(
        F.count(F.lit(1)).alias("values"),
        over(1).alias("first_over_12"),
        over(2).alias("second_over_12"),
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    """Counts of several loads as one."""
    return counts.groupBy("column_name", "layout").agg(*[F.sum(n).alias(n) for n in COUNTED])


def layout_report(counts: DataFrame) -> DataFrame:
    """Adds `field_order`: for short layouts day_first, month_first, mixed or ambiguous, else null."""
    day, month = F.col("first_over_12") > 0, F.col("second_over_12") > 0
    order = (
        F.when(~F.col("layout").isin(list(SHORT)), None)
        .when(day & month, MIXED)
        .when(day, DAY_FIRST)
        .when(month, MONTH_FIRST)
        .otherwise(AMBIGUOUS)
    )
    return counts.select("column_name", "layout", *COUNTED, order.alias("field_order"))


@dataclass(frozen=True)
class Layouts:
    """What the columns of a frame hold: field order by (column, short layout), and the layouts by column.

    A column without an entry in `found` is tried with all layouts that say themselves what their
    fields are; one with an entry with those alone.
    """

    orders: Mapping[tuple[str, str], str] = field(default_factory=dict)
    found: Mapping[str, frozenset[str]] = field(default_factory=dict)

    def ambiguous(self) -> list[tuple[str, str]]:
        return sorted(key for key, order in self.orders.items() if order == AMBIGUOUS)


def settle_layouts(
    counts: DataFrame, overrides: Mapping[str, str] | None = None
) -> Layouts:
    """Layouts from counts; `overrides` gives the order of columns whose owner knows it.

    Collects one row for each column and layout, of which there are about a dozen.
    """
    known = dict(overrides or {})
    wrong = {name: order for name, order in known.items() if order not in (DAY_FIRST, MONTH_FIRST)}
    if wrong:
        raise ValueError(f"the order of a column is {DAY_FIRST} or {MONTH_FIRST}, got {wrong}")
    rows = layout_report(counts).collect()
    orders = {(r["column_name"], r["layout"]): r["field_order"] for r in rows if r["field_order"]}
    kinds: dict[str, set[str]] = {}
    for row in rows:
        kinds.setdefault(row["column_name"], set()).add(row["layout"])
    given = {(name, kind): order for name, order in known.items() for kind in SHORT}
    return Layouts(orders | given, {name: frozenset(own) for name, own in kinds.items()})


def to_moment(name: str, layouts: Layouts = Layouts()) -> Column:
    """The moment that a text tells, or null.

    What Spark's cast reads is taken as it reads it (`to_ntz`). Else the first layout that the text
    fits decides. Day and month of short layouts follow the column's order; in a mixed column, and
    in an ambiguous or unknown one, only values that can be read one way are read.
    """
    standard = ntz_sql(quoted(name))
    kinds = layouts.found.get(name)
    wanted = [k for k in _STARTS if kinds is None or k in kinds]
    if not wanted:
        return F.expr(standard)
    # Inside a lambda the text is named once: spelled out, the code would be too long for the compiler.
    value = "t"
    rules = [(f"(?i)^([0-9]{{1,2}}[ -])?{m}(?=[ -])", f"$1#{k:02d}") for k, m in enumerate(MONTHS, 1)] if _NAMED & set(wanted) else []
    for kind in wanted:
        order = layouts.orders.get((name, kind), AMBIGUOUS)
        rules += _short_rules(SHORT[kind], order) if kind in SHORT else _REWRITTEN.get(kind, ())
    # A twelve-hour clock is read as it stands, and moved by half a day after that.
    rules.append((" ((0?[1-9]|1[0-2]):[0-9]{2}(:[0-9]{2})?) ?[AaPp][Mm]$", " $1"))
    text = value
    for pattern, to in rules:
        text = f"regexp_replace({text}, '{pattern}', '{to}')"
    moved = (
        f"CASE WHEN NOT ({value} RLIKE '[AaPp][Mm]$') THEN INTERVAL '0' HOUR "
        f"WHEN {value} RLIKE ' 12:[0-9:]+ ?[Pp][Mm]$' THEN INTERVAL '0' HOUR "
        f"WHEN {value} RLIKE '[Pp][Mm]$' THEN INTERVAL '12' HOUR "
        f"WHEN {value} RLIKE ' 12:[0-9:]+ ?[Aa][Mm]$' THEN INTERVAL '-12' HOUR ELSE INTERVAL '0' HOUR END"
    )
    rewritten = f"try_cast({text} AS TIMESTAMP_NTZ) + {moved}"
    # Texts without a digit are no dates: most wrong values end here.
    tried = f"CASE WHEN {value} RLIKE '^[0-9A-Za-z].*[0-9]' THEN {rewritten} END"
    trimmed = f"btrim({quoted(name)}, {WHITESPACE_SQL})"
    return F.expr(f"coalesce({standard}, element_at(transform(array({trimmed}), t -> {tried}), 1))")
