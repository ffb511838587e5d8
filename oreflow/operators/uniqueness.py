"""Marking rows whose key occurs more than once, without trusting the key to be well spread."""

from __future__ import annotations

from functools import partial
from math import ceil

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from oreflow.session import staged

#: Column with the place of a row in stored files, where there is one.
PLACE = "_row_place"
# The repeated keys are broadcast only up to this size.
BROADCAST_BYTES = 32 * 1024 * 1024
# Beyond it, the keys that hold the most rows are broadcast on their own; at
# most this many can each hold 1/HOT_KEYS of the repeated rows.
HOT_KEYS = 10_000
# A heavy key longer than this is not broadcast but joined by shuffle, which bounds
# the broadcast at HOT_KEYS times as many bytes.
HOT_KEY_BYTES = 4096
# Generous allowance per hashed row for counts, pointers and page slack.
_ROW_OVERHEAD = 64
# From this many times BROADCAST_BYTES on, shuffle joins hash the repeated keys.
_HASHED_FROM = 4
# The marks of repeated rows, one bit a row, are broadcast up to this size, which is a thousand million rows.
MARKS_BYTES = 128 * 1024 * 1024
# Rows of a file that share one set of marks, as a power of two: as many as Spark's bitmaps have bits.
_BLOCK_BITS = 15


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once and how often; null is a key like any other.

    Partial counts are built before the shuffle, so a key that fills a third
    of the table costs one row per task.
    """
    return (
        df.groupBy(F.col(f"`{key}`").alias("dup_key"))
        .agg(F.count(F.lit(1)).alias("dup_rows"))
        .filter("dup_rows > 1")
    )


def mark_repeated(
    df: DataFrame,
    key: str,
    flag: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    marks_bytes: int = MARKS_BYTES,
) -> DataFrame:
    """Append a boolean column: does this row's key occur in another row as well?

    Runs one job over the key column to stage the repeated keys and measure
    them while they are written (in the job's last stage, where a repeated
    task is counted once), then picks the join by their size:

    * none: no join;
    * small: broadcast, the wide rows stay where they are;
    * large, and the rows tell their place in stored files (`with_place`, whose column is taken off):
      keys and places alone go through one of the joins below, and the rows found are broadcast as one bit
      for each row of a file; wide rows stay where they are, up to ``marks_bytes``;
    * large, but no key is null or heavy: a shuffle join on the key alone;
    * large otherwise: a broadcast for the null key and the few heavy keys (their number
      is bounded by the cut-off, their length by ``HOT_KEY_BYTES``) and a shuffle join for all others. Rows already decided
      by the broadcast carry no join key and are spread by task number, so
      that no reducer receives a heavy group. (The slot of all others is a
      function of the key: a constant would be folded out of the join.)

    Shuffle joins of very many repeated keys hash them, as each stands once, so
    that the wide rows need no sort.
    """
    size = Observation()
    keys = staged(
        repeated_keys(df, key).observe(
            size,
            F.count(F.lit(1)).alias("keys"),
            F.coalesce(F.sum("dup_rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.max("dup_rows"), F.lit(0)).alias("most"),
            F.count_if(F.col("dup_key").isNull()).alias("nulls"),
            F.coalesce(F.sum(F.octet_length(F.col("dup_key").cast("string"))), F.lit(0)).alias(
                "text"
            ),
        ),
        "repeated-keys",
    )
    found = size.get
    own = F.col(f"`{key}`")
    kept = [F.col(f"`{name}`") for name in df.columns if name != PLACE]
    if found["keys"] == 0:
        return df.select(*kept, F.lit(False).alias(flag))

    size_of_keys = found["text"] + found["keys"] * _ROW_OVERHEAD
    if size_of_keys <= broadcast_bytes:
        small = F.broadcast(keys.select("dup_key", F.lit(True).alias("dup_hit")))
        joined = df.join(small, own.eqNullSafe(F.col("dup_key")), "left")
        return joined.select(*kept, F.col("dup_hit").isNotNull().alias(flag))

    cut_off = ceil(found["rows"] / hot_keys)
    # Up to here the optimizer may still broadcast them.
    hashed = size_of_keys > _HASHED_FROM * broadcast_bytes
    by_shuffle = partial(_by_shuffle, own=own, flag=flag, keys=keys, found=found, cut_off=cut_off, hashed=hashed)
    if PLACE in df.columns:
        rows = df.select(own, F.col(f"{PLACE}.file").alias("marks_file"), F.col(f"{PLACE}.row").alias("marks_row"))
        found_rows = by_shuffle(rows, [own, F.col("marks_file"), F.col("marks_row")]).filter(F.col(flag))
        marks = _marks(found_rows, marks_bytes)
        if marks is not None:
            row = F.col(f"{PLACE}.row")
            here = (F.col("marks_file") == F.col(f"{PLACE}.file")) & (F.col("marks_block") == _block(row))
            joined = df.join(F.broadcast(marks), here, "left")
            return joined.select(*kept, F.coalesce(_is_marked(row), F.lit(False)).alias(flag))
    return by_shuffle(df, kept)


def with_place(stored: DataFrame) -> DataFrame:
    """Rows of Parquet files with the file, by 64 bits of hash, and the row number they stand at, for `mark_repeated`.

    Two files are taken for one by chance only: of n files, n * n / 2**65 pairs are expected to.
    """
    file, row = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
    return stored.select("*", F.struct(file.alias("file"), row.alias("row")).alias(PLACE))


def _block(row: Column) -> Column:
    return F.shiftright(row, _BLOCK_BITS)


def _in_block(row: Column) -> Column:
    return row.bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int")


def _marks(rows: DataFrame, most_bytes: int) -> DataFrame | None:
    """These rows' places as bits: one row, of 512 whole numbers, for each block of a file that has any.

    None where that is more than ``most_bytes``. Places are brought together first: a bitmap of each
    task for each block would grow with both.
    """
    size = Observation()
    blocks = rows.select("marks_file", _block(F.col("marks_row")).alias("marks_block"), "marks_row")
    bits = F.bitmap_construct_agg(_in_block(F.col("marks_row"))).alias("bits")
    bitmaps = blocks.repartition("marks_file", "marks_block").groupBy("marks_file", "marks_block").agg(bits)
    # Spark has no look-up of one bit in a bitmap; one in a whole number copies nothing either.
    words = F.expr("transform(sequence(0, 511), i -> cast(conv(hex(substring(bits, i * 8 + 1, 8)), 16, -10) as bigint))")
    marks = bitmaps.select("marks_file", "marks_block", words.alias("marks"))
    kept = staged(marks.observe(size, F.count(F.lit(1)).alias("blocks")), "repeated-rows")
    return kept if size.get["blocks"] * ((1 << _BLOCK_BITS) // 8 + _ROW_OVERHEAD) <= most_bytes else None


def _is_marked(row: Column) -> Column:
    """Whether the bit of a row is set in the joined ``marks``, whose bytes stand in order, the first one highest."""
    place = _in_block(row)
    byte = F.shiftright(place.bitwiseAND(63), 3)
    return F.getbit(F.get("marks", F.shiftright(place, 6)), 56 - byte * 8 + place.bitwiseAND(7)) == 1


def _by_shuffle(
    df: DataFrame, kept: list[Column], *, own: Column, flag: str, keys: DataFrame, found: dict, cut_off: int, hashed: bool
) -> DataFrame:
    """The given columns and the flag, rows brought to their keys."""
    if found["most"] < cut_off and not found["nulls"]:
        listed = keys.select("dup_key", F.lit(True).alias("dup_hit"))
        joined = df.join(
            listed.hint("shuffle_hash") if hashed else listed, own == F.col("dup_key"), "left"
        )
        return joined.select(*kept, F.col("dup_hit").isNotNull().alias(flag))

    short = F.octet_length(F.col("dup_key").cast("string")) <= HOT_KEY_BYTES
    many = F.col("dup_rows") >= cut_off
    heavy = F.col("dup_key").isNull() | (short & many)
    hot = F.broadcast(
        keys.filter(heavy).select(F.col("dup_key").alias("hot_key"), F.lit(True).alias("hot_hit"))
    )
    cold = keys.filter(~heavy).select(
        "dup_key", F.xxhash64("dup_key").alias("dup_slot"), F.lit(True).alias("dup_hit")
    )
    routed = df.join(hot, own.eqNullSafe(F.col("hot_key")), "left").select(
        *kept, F.col("hot_hit").isNotNull().alias("hot_hit")
    )
    decided = F.col("hot_hit") | own.isNull()
    routed = routed.select(
        *kept,
        "hot_hit",
        F.when(~decided, own).alias("route_key"),
        F.when(decided, F.spark_partition_id().cast("bigint"))
        .otherwise(F.xxhash64(own))
        .alias("route_slot"),
    )
    joined = routed.join(
        cold.hint("shuffle_hash") if hashed else cold,
        (F.col("route_key") == F.col("dup_key")) & (F.col("route_slot") == F.col("dup_slot")),
        "left",
    )
    return joined.select(*kept, (F.col("hot_hit") | F.col("dup_hit").isNotNull()).alias(flag))
