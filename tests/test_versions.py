"""Replacement in one step, restart after the last finished step, tables shown without a copy."""

import shutil
import threading

import pytest
from pyspark.sql import functions as F

from oreflow.operators import gold
from oreflow.plans import refresh as plan
from oreflow.plans.refresh import refresh
from oreflow.sources import outputs, versions, writers
from test_refresh_edges import ROWS, write_raw

TS = "2024-05-01 12:00:00"


def contents(spark, out):
    names = [n for n in outputs.PATHS if n not in outputs.OUTSIDE_VERSIONS]
    return {n: sorted(map(str, outputs.load_output(spark, out, n).collect())) for n in names}


def rewrite_checked(df, path):
    writers._replaced(df.sparkSession, path, df.write.partitionBy(outputs.OUTCOME).parquet)


def failing(spark, rows):
    return spark.range(rows).select(F.when(F.col("id") < rows - 1, F.col("id")).otherwise(F.raise_error(F.lit("halfway"))).cast("long").alias("id"))


@pytest.mark.parametrize("write", [writers.replace_parquet, writers.replace_csv])
def test_a_write_that_fails_leaves_the_old_data(spark, tmp_path, write):
    path = str(tmp_path / "t")
    write(spark.range(3), path)
    with pytest.raises(Exception, match="halfway"):
        write(failing(spark, 5), path)
    reader = spark.read.option("header", True)
    assert (reader.csv(path) if write is writers.replace_csv else reader.parquet(path)).count() == 3
    write(spark.range(7), path)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_table_write_that_fails_leaves_the_old_table(spark, tmp_path):
    writers.replace_table(spark.range(3), "atomic_table", str(tmp_path / "t"))
    with pytest.raises(Exception, match="halfway"):
        writers.replace_table(failing(spark, 5), "atomic_table", str(tmp_path / "t"))
    assert spark.table("atomic_table").count() == 3
    running = spark.table("atomic_table")
    writers.replace_table(spark.range(4), "atomic_table", str(tmp_path / "t"))
    assert spark.table("atomic_table").count() == 4 and running.count() in (3, 4)
    for _ in range(3):
        writers.replace_table(spark.range(2).select("id", F.lit("x").alias("x")), "atomic_table", str(tmp_path / "t"))
    assert spark.table("atomic_table").count() == 2 and len(list((tmp_path / "t").iterdir())) == writers.KEPT
    spark.sql("DROP TABLE atomic_table")


def test_pointer_lists_versions_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path)
    runs = [versions.Run.start(spark, root, {"fingerprint": str(n)}) for n in range(5)]
    for run in runs[:4]:
        versions.publish(spark, root, run.version, keep=2)
    assert versions.published(spark, root) == [runs[3].version, runs[2].version]
    # The fifth is under way and stays, until it is known to have failed.
    assert set(versions.folders(spark, f"{root}/{versions.VERSIONS}")) == {r.version for r in runs[2:]}
    runs[4].failed()
    versions.publish(spark, root, runs[3].version)
    assert runs[4].version not in versions.folders(spark, f"{root}/{versions.VERSIONS}")


def test_two_writers_one_wins_whole(spark, tmp_path):
    root, tables, errors = str(tmp_path), ("gold_customer_360", "gold_product_performance"), []

    def write(writer):
        try:
            run = versions.Run.start(spark, root, {"fingerprint": str(writer)})
            for table in tables:
                writers.replace_parquet(spark.range(1).select(F.lit(writer).alias("w")), outputs.output_path(run.path, table))
            for _ in range(20):
                versions.publish(spark, root, run.version, keep=9)
        except Exception as error:  # an assertion in a thread would be lost
            errors.append(error)

    threads = [threading.Thread(target=write, args=(n,)) for n in (1, 2)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert errors == []
    assert len({outputs.load_output(spark, root, table).first().w for table in tables}) == 1


def test_a_stopped_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    raw, out = write_raw(spark, tmp_path / "raw"), str(tmp_path / "out")
    refresh(spark, write_raw(spark, tmp_path / "old", products=[*ROWS["products"], ("P9", "x", "x", "x")]), out)
    before = contents(spark, out)

    def broken(*args, **named):
        raise RuntimeError("killed in gold")

    with monkeypatch.context() as m:
        m.setattr(gold, "product_performance", broken)
        with pytest.raises(RuntimeError, match="killed in gold"):
            refresh(spark, raw, out)
    assert contents(spark, out) == before  # readers notice nothing

    loaded = []
    with monkeypatch.context() as m:
        m.setattr(plan, "read_raw", lambda *args, **named: loaded.append(args) or broken())
        m.setattr(plan, "write_checked", broken)
        refresh(spark, raw, out, resume=True)
    assert loaded == []  # no raw file is read, no bronze table checked again
    resumed = contents(spark, out)
    audit = outputs.load_output(spark, out, "bronze_load_audit").first()
    refresh(spark, raw, str(tmp_path / "whole"), run_ts=audit.loaded_at_utc, load_id=audit.bronze_load_id)
    assert resumed == contents(spark, str(tmp_path / "whole")) and resumed != before


def test_other_files_settings_or_code_start_anew(spark, tmp_path, monkeypatch):
    raw = write_raw(spark, tmp_path / "raw")
    told = versions.fingerprint(spark, raw, {"a": 1})
    assert told == versions.fingerprint(spark, raw, {"a": 1}) != versions.fingerprint(spark, raw, {"a": 2})
    (tmp_path / "raw" / "more.csv").write_text("x")
    assert told != (now := versions.fingerprint(spark, raw, {"a": 1}))
    monkeypatch.setattr(versions, "code_version", lambda: "other")
    assert now != versions.fingerprint(spark, raw, {"a": 1})
    run = versions.Run.start(spark, str(tmp_path / "out"), {"fingerprint": told})
    assert versions.Run.unfinished(spark, str(tmp_path / "out"), now) is None
    assert versions.Run.unfinished(spark, str(tmp_path / "out"), told).version == run.version


def test_registering_copies_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    refresh(spark, write_raw(spark, tmp_path / "raw"), out, database="shown")
    assert spark.table("shown.silver_products").first().product_id == "P1"
    shutil.copytree(versions.current_root(spark, out), versions.version_path(out, "second"))
    for table in ("silver_products", "gold_product_performance"):
        place = outputs.output_path(versions.version_path(out, "second"), table)
        changed = spark.read.parquet(place).withColumn("product_id", F.lit("P2"))
        (writers.replace_parquet if table.startswith("gold") else rewrite_checked)(changed, place)
    versions.publish(spark, out, "second")
    plan.register(spark, out, "shown")
    assert spark.table("shown.silver_products").first().product_id == "P2"
    assert spark.table("shown.gold_product_performance").first().product_id == "P2"
    root = versions.current_root(spark, out)
    for name in ("shown.gold_customer_360", "shown.silver_accounts", "shown.governance_issue_log"):
        assert all(root in f for f in spark.table(name).inputFiles())
    spark.sql("DROP DATABASE shown CASCADE")
    assert outputs.load_output(spark, out, "gold_customer_360").count() == 1
