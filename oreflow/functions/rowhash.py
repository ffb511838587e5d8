"""Row fingerprints."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreflow.functions.text import quoted


def row_hash(names: Iterable[str]) -> Column:
    """md5 over the text of the named columns.

    Each text carries its length and null has its own mark, so neither a
    delimiter inside a value nor a null next to an equal text can make two
    different rows look the same.
    """
    texts = [f"CAST({quoted(name)} AS STRING)" for name in names]
    parts = ", ".join(f"coalesce(concat(length({t}), ':', {t}), '-')" for t in texts)
    return F.expr(f"md5(concat_ws('|', {parts}))")
