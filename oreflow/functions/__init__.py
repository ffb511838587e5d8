"""Column expressions shared by the operators; all built from Spark's own functions."""

from oreflow.functions.exact import exact_sums
from oreflow.functions.numbers import guarded_ratio, round_half_away, to_double
from oreflow.functions.rowhash import row_hash
from oreflow.functions.sums import stable_avg, stable_sum
from oreflow.functions.text import fold_case, is_blank, null_if_na, quoted, strip
from oreflow.functions.times import to_boolean, to_ntz

__all__ = [
    "exact_sums",
    "fold_case",
    "guarded_ratio",
    "is_blank",
    "null_if_na",
    "quoted",
    "round_half_away",
    "row_hash",
    "stable_avg",
    "stable_sum",
    "strip",
    "to_boolean",
    "to_double",
    "to_ntz",
]
