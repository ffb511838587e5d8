import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

from oreflow.model import SourceSpec, text_schema
from oreflow.operators.bronze import add_load_metadata
from oreflow.registry import SOURCES
from oreflow.session import scratch_path, shared_folder
from oreflow.sources import outputs, readers, writers

TYPED = StructType(
    [
        StructField("id", StringType()),
        StructField("amount", DoubleType()),
        StructField("flag", BooleanType()),
    ]
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_csv_types_and_missing_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,amount,flag\n a ,1.5,True\nNA,,False\nb,nan,\n")
    assert rows(readers.read_csv(spark, path, TYPED)) == [
        (" a ", 1.5, True), (None, None, False), ("b", None, None),
    ]


def test_csv_without_schema_is_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", "B,a\n1,N/A\n")
    df = readers.read_csv(spark, path)
    assert df.columns == ["B", "a"] and rows(df) == [("1", None)]


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    text = 'id,note\n1,"a ""b"", c"\n2,"x\ny"\n'
    path = write(tmp_path / "a.csv", text)
    df = readers.read_csv(spark, path, text_schema("id", "note"), multi_line=True)
    assert rows(df) == [("1", 'a "b", c'), ("2", "x\ny")]


@pytest.mark.parametrize("text", ["id,amount,flag\n1,2\n", "id,amount,flag\n1,x,True\n",
                                  "id,other,flag\n1,2,True\n"])
def test_csv_fails_on_broken_rows(spark, tmp_path, text):
    path = write(tmp_path / "a.csv", text)
    with pytest.raises(Exception, match="(?i)malformed|cast|header|failed"):
        readers.read_csv(spark, path, TYPED).collect()


def test_json_array(spark, tmp_path):
    records = [{"id": "1", "amount": 1.25, "flag": True}, {"id": "2"}]
    path = write(tmp_path / "a.json", json.dumps(records, indent=2))
    assert rows(readers.read_json_array(spark, path, TYPED)) == [
        ("1", 1.25, True), ("2", None, None),
    ]
    as_text = readers.read_json_array(spark, path, text_schema("amount", "flag"))
    assert rows(as_text) == [("1.25", "true"), (None, None)]


def test_json_lines_skip_blank_lines(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"id": "1"}\n\n   \n{"id": "2", "amount": 3}\n')
    assert rows(readers.read_json_lines(spark, path, TYPED)) == [
        ("1", None, None), ("2", 3.0, None),
    ]


def test_json_lines_fail_on_a_bad_line(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"id": "1"}\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed|failed"):
        readers.read_json_lines(spark, path, TYPED).collect()


def test_registry_dispatch(spark, tmp_path):
    write(tmp_path / "products.csv",
          "product_id,product_name,product_type,business_domain\nP1,a,b,c\n")
    assert rows(readers.read_raw(spark, SOURCES["products"], str(tmp_path))) == [
        ("P1", "a", "b", "c"),
    ]
    with pytest.raises(AnalysisException) as missing:
        readers.read_raw(spark, SOURCES["customers"], str(tmp_path))
    assert missing.value.getCondition() == "PATH_NOT_FOUND"
    odd = SourceSpec("x", "x.xml", "xml", "s", text_schema("a"))
    with pytest.raises(ValueError, match="xml"):
        readers.read_raw(spark, odd, str(tmp_path))


def test_registry_names_seven_sources():
    assert [(s.name, s.file_format) for s in SOURCES.values()] == [
        ("customers", "csv"), ("accounts", "csv"), ("products", "csv"), ("transactions", "csv"),
        ("customer_service_notes", "csv"), ("exchange_rates_api", "json"),
        ("fraud_alert_events", "jsonl"),
    ]


def test_source_file_of_a_folder_is_the_part_file(spark, tmp_path):
    folder = tmp_path / "in.csv"
    folder.mkdir()
    write(folder / "one.csv", "id\n1\n")
    write(folder / "two.csv", "id\n2\n")
    df = readers.read_csv(spark, str(folder), text_schema("id"))
    tagged = add_load_metadata(df, load_id="l", ingested_at="t", source_system="s")
    assert sorted(rows(tagged.select("id", "_source_file"))) == [
        ("1", "one.csv"), ("2", "two.csv"),
    ]


def test_writes_replace(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    writers.replace_parquet(spark.range(5), path)
    writers.replace_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    writers.replace_table(spark.range(5), "replaced_table")
    writers.replace_table(spark.range(3).withColumn("x", F.lit("a")), "replaced_table")
    assert readers.read_table(spark, "replaced_table").count() == 3
    spark.sql("DROP TABLE replaced_table")


def test_csv_report_round_trip(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    df = spark.createDataFrame([(' a, "b" ', "x"), (None, "y")], "t string, u string")
    writers.replace_csv(df, path, single_file=True)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert sorted(rows(back), key=str) == sorted(rows(df), key=str)


def test_raw_files_of_a_refresh_are_packed(spark, tmp_path, monkeypatch):
    from workload import catalog

    lines = [StructField(name, StringType()) for name in ("id", "note")]
    made = spark.createDataFrame([("1", 'a, "b"'), (None, " c ")], StructType(lines)).repartition(2)
    monkeypatch.setattr(catalog, "raw", lambda spark, folder, name: made)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, label: str(tmp_path / label))
    landing = catalog.write_raw_files(spark, "")
    for name, spec in SOURCES.items():
        files = [f for f in (tmp_path / "raw" / spec.file_name).iterdir() if f.name.startswith("part-")]
        assert files and (spec.file_format == "json" or all(f.name.endswith(".gz") for f in files))
        own = SourceSpec(name, spec.file_name, spec.file_format, "s", StructType(lines))
        assert sorted(rows(readers.read_raw(spark, own, landing)), key=str) == sorted(rows(made), key=str)


def test_load_output(spark, tmp_path):
    root = str(tmp_path)
    writers.replace_parquet(spark.range(4), outputs.output_path(root, "gold_customer_360"))
    assert outputs.load_output(spark, root, "gold_customer_360").count() == 4
    with pytest.raises(FileNotFoundError, match="ml_customer_risk_features"):
        outputs.load_output(spark, root, "ml_customer_risk_features")
    with pytest.raises(ValueError, match="unsupported"):
        outputs.load_file(spark, f"{root}/x.txt")
    with pytest.raises(KeyError):
        outputs.load_output(spark, root, "no_such_table")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
