"""Files read in ranges by many tasks."""

import bz2
import csv
import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from oreflow.model import text_schema
from oreflow.sources import readers
from oreflow.sources.ranges import backslashes_before, csv_headers, files_below, ranges_of, records_of
from workload import catalog

TEXT = text_schema("id", "note")


def odd_text(rng):
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "x", " ", "\U0001f600", "\\\\\""]) for _ in range(rng.randint(0, 30)))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [7, 61, 1000])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_array_in_ranges(spark, tmp_path, size, indent):
    rng = random.Random(size)
    records = [{"id": str(k), "note": odd_text(rng), "more": {"a": [odd_text(rng), {"b": "]"}]}} for k in range(40)]
    path = tmp_path / "a.json"
    path.write_text(("﻿" if size == 61 else "") + json.dumps(records, indent=indent, ensure_ascii=size == 7) + "\n ", encoding="utf-8")
    found = readers.read_json_array(spark, str(path), TEXT, range_bytes=size)
    assert rows(found) == sorted(((r["id"], r["note"]) for r in records), key=str)


def test_json_ranges_are_tasks_and_files_mix(spark, tmp_path):
    for name, n in (("big.json", 400), ("small.json", 2), ("none.json", 0)):
        (tmp_path / name).write_text(json.dumps([{"id": f"{name}{k}", "note": "x" * 50} for k in range(n)], indent=1))
    found = readers.read_json_array(spark, str(tmp_path), TEXT, with_file=True, range_bytes=3000)
    assert found.count() == 402
    parts = found.filter(F.col("id").startswith("big")).select(F.spark_partition_id().alias("p"), readers.READ_FROM)
    assert parts.select("p").distinct().count() > 3
    assert [r[0].rsplit("/", 1)[1] for r in parts.select(readers.READ_FROM).distinct().collect()] == ["big.json"]


@pytest.mark.parametrize("text", [
    '[{"id": "1"}, {"id": "2"', '[{"id": "1"} {"id": "2"}]', '[{"id": "1"},, {"id": "2"}]', '[{"id": "1"}, 5, {"id": "2"}]', '[{"id": "1"}]] ',
    '[{"id": "1"}] [{"id": "2"}]', '{"id": "1"}, {"id": "2"}', '[{"id": "1"}, {"id": "2"},]', '[{"id": "1}, {"id": "2"}]', '[{"id" "1"}, {"id": "2"}]',
])
@pytest.mark.parametrize("size", [5, 13])
def test_broken_arrays_fail_in_ranges_too(spark, tmp_path, text, size):
    path = tmp_path / "a.json"
    path.write_text(text)
    with pytest.raises(Exception, match="(?i)broken|malformed|ends inside|parse"):
        readers.read_json_array(spark, str(path), TEXT, range_bytes=size).collect()


def test_csv_columns_follow_each_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n1,one\n")
    (tmp_path / "b.csv").write_text('note,extra,id\n"two, ""2""",x,2\n')
    (tmp_path / "c.csv").write_text("id,new\n3,y\n")
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="header of .*c.csv lacks note"):
        readers.read_csv(spark, str(tmp_path), TEXT)
    found = readers.read_csv(spark, str(tmp_path), TEXT, missing_as_null=True, with_file=True)
    assert rows(found.select("id", "note")) == [("1", "one"), ("2", 'two, "2"'), ("3", None)]
    assert sorted(r[0].rsplit("/", 1)[1] for r in found.select(readers.READ_FROM).collect()) == ["a.csv", "b.csv", "c.csv"]


@pytest.mark.parametrize("ending", [".gz", ".bz2"])
def test_headers_of_packed_files_are_read_without_a_job_each(spark, tmp_path, monkeypatch, ending):
    packed = {".gz": gzip.compress, ".bz2": bz2.compress}[ending]
    long = "x" * 100_000  # more than is unpacked at first
    texts = ["id,note\n1,one\n", f'note,"{long}\n",id\r\ntwo,x,2\r\n', "id,note", ""]
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.csv{ending}").write_bytes(packed(text.encode()))
    found = csv_headers(spark, [f"file:{tmp_path}/{k}.csv{ending}" for k in range(4)])
    assert [*found.values()] == [["id", "note"], ["note", f"{long}\n", "id"], ["id", "note"], []]
    (tmp_path / f"3.csv{ending}").unlink()
    (tmp_path / f"1.csv{ending}").write_bytes(packed(b"note,extra,id\ntwo,x,2\n"))
    asked = []
    monkeypatch.setattr(readers, "csv_headers", lambda spark, files: asked.extend(files) or csv_headers(spark, files))
    assert rows(readers.read_csv(spark, str(tmp_path), TEXT)) == [("1", "one"), ("2", "two")]
    assert len(asked) == 3


@pytest.mark.parametrize("size", [9, 64, 5000])
def test_csv_line_breaks_in_ranges(spark, tmp_path, size):
    rng = random.Random(size)
    letters = ['"', ",", "\n", "\r\n", "é", "x", " ", "'", "\\"]
    records = [(str(k), "n" + "".join(rng.choice(letters[:8]) for _ in range(rng.randint(0, 30))) + "z") for k in range(60)]
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\r\n" if size == 64 else "\n")
    writer.writerow(["note", "id"])
    writer.writerows([(b, a) for a, b in records])
    path = tmp_path / "a.csv"
    path.write_bytes(text.getvalue().encode())
    found = readers.read_csv(spark, str(path), TEXT, multi_line=True, range_bytes=size)
    assert rows(found) == sorted(records, key=str)
    if size == 9:
        assert found.select(F.spark_partition_id()).distinct().count() > 3


def test_csv_ranges_fail_on_an_open_quote_and_wrong_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,note\n1,"open\n2,x\n')
    with pytest.raises(Exception, match="(?i)ends inside"):
        readers.read_csv(spark, str(path), TEXT, multi_line=True, range_bytes=4).collect()
    path.write_text("id,note\n1,x\n2,y,z\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.read_csv(spark, str(path), TEXT, multi_line=True, range_bytes=4).collect()


def test_records_and_backslashes_at_every_cut():
    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    raw = b'a,"b\nc"\n\nd,""\ne,"x""\n"'
    whole = [b'a,"b\nc"', b"", b'd,""', b'e,"x""\n"']
    for cut in range(1, len(raw)):
        inside = raw[:cut].count(b'"') % 2 == 1
        assert [*records_of(File(raw), 0, cut, False), *records_of(File(raw), cut, len(raw), inside)] == whole
    assert backslashes_before(File(b"\\" * 5000), 5000) == 5000
    assert backslashes_before(File(b"a\\\\"), 3) == 2


def test_files_and_ranges(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "b").write_text("12345")
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "a").write_text("12")
    files = files_below(spark, str(tmp_path))
    assert [(f.rsplit("/", 1)[1], n) for f, n in files] == [("a", 2), ("b", 5)]
    assert sorted((r.start, r.end) for r in ranges_of(spark, files, 2).collect()) == [(0, 2), (0, 2), (2, 4), (4, 5)]
    assert files_below(spark, str(tmp_path / "nothing")) == []


def test_ranges_are_dealt_evenly_whatever_the_name(spark):
    for name in "abcde":
        dealt = ranges_of(spark, [(name, 40)], 10).select(F.spark_partition_id().alias("p"))
        assert dealt.distinct().count() == 4


def test_many_small_ranges_share_tasks(spark):
    dealt = ranges_of(spark, [("a", 4000)], 2)
    assert dealt.count() == 2000 and dealt.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_a_small_range_reads_little_more_than_itself():
    text = b'"a\n",b\n' * 400_000
    file = io.BytesIO(text)
    file.size = lambda: len(text)
    found = list(records_of(file, 0, 7000, False))
    assert len(found) == 1000 and file.tell() <= 256 << 10


def test_queries_write_their_files_with_all_tasks(spark, tmp_path, monkeypatch):
    """No file of the range readers' queries is written by one task for all rows."""
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name in ("read_json_array", "read_csv"):
        monkeypatch.setattr(readers, name, lambda spark, path, *rest, **more: seen.append(path))
    catalog.src_json_array_split(spark, str(tmp_path))
    catalog.src_csv_headers(spark, str(tmp_path))
    assert [len(files_below(spark, path)) for path in seen] == [3, 9]
