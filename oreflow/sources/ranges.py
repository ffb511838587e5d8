"""One large file read by many tasks, where its format has no line that a task could start at.

A file is cut into byte ranges. A first pass over the ranges notes how each one changes the state of
a reader, for every state it may start in; putting the ranges in order then gives the state at each
cut, and a second pass reads every range from there. The driver sees one short row a range.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of a range, and of the pieces that a task reads it in.
RANGE_BYTES = 64 << 20
PIECE_BYTES = 4 << 20
#: Least piece: what is read behind a range to find the end of its last value.
LEAST_BYTES = 64 << 10
#: Files whose headers the driver, or one task, reads itself.
FEW = 64

QUOTE, BACKSLASH = 0x22, 0x5C
_OPEN, _CLOSE = (0x5B, 0x7B), (0x5D, 0x7D)
_BLANK = b" \t\r\n"
_MARK = b"\xef\xbb\xbf"
#: Files with these endings can be read from their start only.
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")
#: Those that Arrow unpacks, as Hadoop writes them too.
UNPACKED = {".gz": "gzip", ".bz2": "bz2"}


class BrokenFile(ValueError):
    """The file is not what its format says."""


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Full name and length of every data file of a path; names that start with `_` or `.` are none."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    if system.getFileStatus(root).isFile():
        return [(system.getFileStatus(root).getPath().toString(), system.getFileStatus(root).getLen())]
    found, listed = [], system.listFiles(root, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def opened(name: str) -> pa.NativeFile:
    """A file of any store that Arrow knows, by the name the cluster's file system gives it."""
    from pyarrow import fs

    uri = name.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        # Spark writes file:/a as well as file:///a, and does not encode names.
        return fs.LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/"))
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner)


def pieces(file: io.RawIOBase, start: int, end: int) -> Iterator[bytes]:
    file.seek(start)
    while start < end:
        piece = file.read(min(PIECE_BYTES, end - start))
        if not piece:
            return
        start += len(piece)
        yield bytes(piece)


def _piece(at: int, end: int) -> int:
    """Bytes to read next: little more than the range, however small it is."""
    return max(min(PIECE_BYTES, end - at), LEAST_BYTES)


def backslashes_before(file: io.RawIOBase, start: int) -> int:
    """How many backslashes stand right before a place."""
    count = 0
    while start > 0:
        size = min(4096, start)
        file.seek(start - size)
        before = bytes(file.read(size))
        run = len(before) - len(before.rstrip(b"\\"))
        count += run
        if run < size:
            break
        start -= size
    return count


def ranges_of(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int) -> DataFrame:
    """file, start and end of every range."""
    rows = [(name, at, min(at + range_bytes, size)) for name, size in files for at in range(0, size, range_bytes)]
    return _dealt(spark, rows, "file string, start long, end long")


def _dealt(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Ranges dealt to tasks: one each where they are large, about RANGE_BYTES together where there are many small ones."""
    frame = spark.createDataFrame(rows, schema)
    size = sum(row[2] - row[1] for row in rows)
    tasks = max(size // RANGE_BYTES + 1, spark.sparkContext.defaultParallelism)
    # In order: by hash, some tasks would get several ranges and others none.
    return frame.repartitionByRange(min(len(rows), tasks), "file", "start") if rows else frame


def _with_states(ranges: DataFrame, states: dict[tuple[str, int], tuple], schema: str) -> DataFrame:
    """Each range with the state at its start beside it, so that a task gets those of its own ranges only."""
    rows = [(*row, *states[row["file"], row["start"]]) for row in ranges.collect()]
    return _dealt(ranges.sparkSession, rows, f"file string, start long, end long, {schema}")


# --- JSON ---------------------------------------------------------------------


def real_quotes(piece: np.ndarray, carried: int) -> tuple[np.ndarray, int]:
    """Places of the quotes without a backslash that escapes them, and the backslashes at the end."""
    is_slash = piece == BACKSLASH
    quotes = np.flatnonzero(piece == QUOTE)
    if not is_slash.any():
        return (quotes[1:] if len(quotes) and quotes[0] == 0 and carried % 2 else quotes), 0
    other = np.maximum.accumulate(np.where(is_slash, -1, np.arange(len(piece))))
    before = np.where(quotes > 0, other[quotes - 1], -1)
    run = quotes - 1 - before + np.where(before < 0, carried, 0)
    last = int(other[-1])
    return quotes[run % 2 == 0], len(piece) - 1 - last + (carried if last < 0 else 0)


def _steps(piece: np.ndarray) -> np.ndarray:
    """1 where a bracket opens, -1 where one closes."""
    return np.isin(piece, _OPEN).astype(np.int8) - np.isin(piece, _CLOSE).astype(np.int8)


def _inside(n: int, quotes: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each byte is inside a string; a string's last quote is not."""
    flips = np.zeros(n, np.int8)
    flips[quotes] = 1
    return (np.cumsum(flips, dtype=np.int64) + inside) % 2 == 1


def _json_effect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a start outside and inside a string: whether the end is inside one, and the change of depth."""
    for batch in batches:
        out = []
        for name, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            depth, flips = [0, 0], 0
            with opened(name) as file:
                carried = backslashes_before(file, start)
                for raw in pieces(file, start, end):
                    piece = np.frombuffer(raw, np.uint8)
                    quotes, carried = real_quotes(piece, carried)
                    steps, inside = _steps(piece), _inside(len(piece), quotes, flips % 2 == 1)
                    depth[0] += int(steps[~inside].sum())
                    depth[1] += int(steps[inside].sum())
                    flips += len(quotes)
            out.append((name, start, flips % 2, *depth))
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), *[pa.int64()] * 4), strict=True)] if out else [pa.array([], t) for t in (pa.string(), *[pa.int64()] * 4)]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "start", "flips", "outside", "inside"])


def json_states(ranges: DataFrame) -> dict[tuple[str, int], tuple[bool, int]]:
    """Whether a string is open and how many brackets are, at the start of every range; one row a range is collected."""
    effects = ranges.mapInArrow(_json_effect, "file string, start long, flips long, outside long, inside long").collect()
    states, inside, depth, own = {}, False, 0, None
    for row in [*sorted(effects, key=lambda r: (r["file"], r["start"])), None]:
        if row is None or row["file"] != own:
            if own is not None and (inside or depth):
                raise BrokenFile(f"{own} ends inside a value")
            inside, depth, own = False, 0, row and row["file"]
        if row is not None:
            states[row["file"], row["start"]] = inside, depth
            depth += row["inside"] if inside else row["outside"]
            inside ^= bool(row["flips"])
    return states


def _between(raw: bytes, first: bool) -> None:
    """What may stand before an object: the array's start, or one comma."""
    text = raw.strip(_BLANK)
    if text != (b"[" if first else b","):
        raise BrokenFile(f"an object or the end of the array was expected, found {text[:40]!r}")


def objects_of(file: io.RawIOBase, start: int, end: int, inside: bool, depth: int) -> Iterator[bytes]:
    """The array's objects that start in a range, each whole, though it ends behind the range."""
    carried, size = backslashes_before(file, start), file.size()
    at, held, gap = start, None, b""  # an object that is open, and what came since the last one
    known = start == 0  # whether the gap is whole: the first one may have begun before the range
    first = start == 0
    file.seek(start)
    while at < size:
        raw = bytes(file.read(min(_piece(at, end), size - at)))
        if at == 0 and raw.startswith(_MARK):
            raw = b"   " + raw[3:]
        piece = np.frombuffer(raw, np.uint8)
        quotes, carried = real_quotes(piece, carried)
        within = _inside(len(piece), quotes, inside)
        steps = np.where(within, 0, _steps(piece))
        levels = depth + np.cumsum(steps, dtype=np.int64)
        if (levels < 0).any() or (depth == 0 and at and raw.strip(_BLANK)):
            raise BrokenFile("there is more behind the end of the array")
        begins = np.flatnonzero((steps == 1) & (levels == 2))
        ends = np.flatnonzero((steps == -1) & (levels == 1))
        marks = sorted([(int(b), 0) for b in begins] + [(int(e), 1) for e in ends])
        done = 0
        for place, kind in marks:
            if kind == 0:
                gap += raw[done:place]
                if at + place >= end:
                    # The object belongs to the next range; what is before it was this one's to check.
                    if known:
                        _between(gap, first)
                    return
                if known:
                    _between(gap, first)
                if raw[place : place + 1] != b"{":
                    raise BrokenFile("an element of the array is not an object")
                known, first, gap, held, done = True, False, b"", b"", place
            else:
                if held is not None:
                    yield held + raw[done : place + 1]
                    held, known = None, True
                gap, done = b"", place + 1
        if held is not None:
            held += raw[done:]
        else:
            gap += raw[done:]
        inside, depth = (inside + len(quotes)) % 2 == 1, int(levels[-1]) if len(levels) else depth
        at += len(raw)
        if at >= end and held is None and not known and not marks:
            # Nothing starts here: an object of an earlier range goes on.
            return
    if known:
        text = gap.strip(_BLANK)
        if text != (b"[]" if first else b"]") and not (first and b"".join(text.split()) == b"[]"):
            raise BrokenFile(f"the array does not end, found {text[:40]!r}")


def _json_objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, start, end, inside, depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held, size = [], 0
            with opened(name) as file:
                for value in objects_of(file, start, end, inside, depth):
                    held.append(value)
                    size += len(value)
                    if size >= PIECE_BYTES:
                        yield _texts(held, name)
                        held, size = [], 0
            yield _texts(held, name)


def _texts(values: list[bytes], name: str) -> pa.RecordBatch:
    """Values as text, and the name of their file; bytes that are no UTF-8 fail."""
    texts = pa.array(values, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([texts, pa.array([name] * len(values), pa.string())], names=["value", "file"])


def json_objects(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """value (the text of an object) and file, for every object of files that each hold one JSON array.

    Files are UTF-8. An array that does not end, elements that are no objects, and text between or
    behind them fail with BrokenFile: what ends inside a value at once, all else when rows are read.
    """
    ranges = ranges_of(spark, files, range_bytes)
    placed = _with_states(ranges, json_states(ranges), "inside boolean, depth long")
    return placed.mapInArrow(_json_objects, "value string, file string")


# --- CSV ----------------------------------------------------------------------


def _csv_effect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a range has an odd number of quotes: a doubled quote inside a value changes nothing."""
    for batch in batches:
        out = []
        for name, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with opened(name) as file:
                out.append((name, start, sum(raw.count(b'"') for raw in pieces(file, start, end)) % 2))
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)] if out else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "start", "flips"])


def csv_states(ranges: DataFrame) -> dict[tuple[str, int], bool]:
    """Whether a quoted value is open at the start of every range; one row a range is collected."""
    rows = ranges.mapInArrow(_csv_effect, "file string, start long, flips long").collect()
    states, inside, own = {}, False, None
    for row in [*sorted(rows, key=lambda r: (r["file"], r["start"])), None]:
        if row is None or row["file"] != own:
            if own is not None and inside:
                raise BrokenFile(f"{own} ends inside a quoted value")
            inside, own = False, row and row["file"]
        if row is not None:
            states[row["file"], row["start"]] = inside
            inside ^= bool(row["flips"])
    return states


def records_of(file: io.RawIOBase, start: int, end: int, inside: bool) -> Iterator[bytes]:
    """The CSV records that start in a range, each whole, without the line break that ends them."""
    size, at, held = file.size(), start, None
    if start == 0:
        held = b""
    elif not inside:
        # A record starts right here if a line ended right before.
        file.seek(start - 1)
        held = b"" if bytes(file.read(1)) == b"\n" else None
    file.seek(start)
    while at < size:
        raw = bytes(file.read(min(_piece(at, end), size - at)))
        piece = np.frombuffer(raw, np.uint8)
        flips = np.zeros(len(piece), np.int8)
        flips[piece == QUOTE] = 1
        within = (np.cumsum(flips, dtype=np.int64) + inside) % 2 == 1
        done = 0
        for place in np.flatnonzero((piece == 0x0A) & ~within).tolist():
            if held is not None:
                yield (held + raw[done:place]).removesuffix(b"\r")
            held, done = b"", place + 1
            if at + done >= end:
                return
        if held is not None:
            held += raw[done:]
        elif at + len(raw) >= end:
            return
        inside = bool(within[-1]) if len(within) else inside
        at += len(raw)
    if held:
        yield held.removesuffix(b"\r")


def _csv_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, start, end, inside in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held, size = [], 0
            with opened(name) as file:
                for k, record in enumerate(records_of(file, start, end, inside)):
                    if start == 0 and k == 0:
                        continue  # the header
                    if not record.strip():
                        continue
                    held.append(record)
                    size += len(record)
                    if size >= PIECE_BYTES:
                        yield _texts(held, name)
                        held, size = [], 0
            yield _texts(held, name)


def csv_records(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """value (the text of a record, line breaks inside quotes included) and file, without the files' headers.

    Quotes inside values are doubled; a quoted value may span lines and ranges. Blank lines are skipped.
    """
    ranges = ranges_of(spark, files, range_bytes)
    states = {place: (inside,) for place, inside in csv_states(ranges).items()}
    return _with_states(ranges, states, "inside boolean").mapInArrow(_csv_records, "value string, file string")


def csv_headers(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Column names of each file by its own first record; one short row a file is collected."""
    if len(files) <= FEW:
        found = [pa.Table.from_batches(_headers(iter([pa.RecordBatch.from_arrays([pa.array(files, pa.string())], names=["file"])])))] if files else []
        texts = {r["file"]: r["header"] for table in found for r in table.to_pylist()}
    else:
        frame = spark.createDataFrame([(f,) for f in files], "file string").repartition(len(files) // FEW)
        texts = {r["file"]: r["header"] for r in frame.mapInArrow(_headers, "file string, header string").collect()}
    return {name: next(csv.reader(io.StringIO(text)), []) for name, text in texts.items()}


def _first_record(name: str) -> bytes:
    """The first CSV record of a file; of a packed one no more is unpacked than it takes."""
    with opened(name) as file:
        kind = next((kind for ending, kind in UNPACKED.items() if name.endswith(ending)), None)
        if kind is None:
            return next(records_of(file, 0, 1, False), b"")
        unpacked, start = pa.CompressedInputStream(file, kind), b""
        while True:
            more = unpacked.read(max(LEAST_BYTES, len(start)))
            start += more
            # The first record is whole where another one follows it, or nothing does.
            records = list(islice(records_of(pa.BufferReader(start), 0, len(start) + 1, False), 2))
            if len(records) > 1 or not more:
                return records[0] if records else b""


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).to_pylist()
        texts = []
        for name in names:
            texts.append(_first_record(name).removeprefix(_MARK).decode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["file", "header"])

