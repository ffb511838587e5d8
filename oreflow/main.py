"""Runs a refresh: ``spark-submit oreflow/main.py --raw ... --out ...`` or ``python -m oreflow.main``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from oreflow.operators.checks import QualityLimits
from oreflow.plans.refresh import refresh
from oreflow.session import tuned


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Rebuild all tables from raw files.")
    parser.add_argument("--raw", required=True, help="folder of the raw files")
    parser.add_argument("--out", required=True, help="folder of the tables")
    parser.add_argument("--database", help="catalog database to publish the tables in")
    parser.add_argument("--run-ts", help="run time as text, now in UTC by default")
    parser.add_argument("--load-id", help="id of the load, made up by default")
    parser.add_argument("--strict-nulls", action="store_true", help="reject undecided rows")
    parser.add_argument("--date-layouts", action="store_true", help="read dates in the layouts people write")
    parser.add_argument("--gates", action="store_true", help="measure the quality gates")
    parser.add_argument("--fail-on-breach", action="store_true", help="stop on a broken gate")
    parser.add_argument("--resume", action="store_true", help="go on with the last run that was stopped")
    given = parser.parse_args(arguments)
    measured = given.gates or given.fail_on_breach
    refresh(
        tuned(SparkSession.builder.appName("oreflow")).getOrCreate(),
        given.raw,
        given.out,
        run_ts=given.run_ts,
        load_id=given.load_id,
        strict_nulls=given.strict_nulls,
        date_layouts=given.date_layouts,
        limits=QualityLimits(fail_on_breach=given.fail_on_breach) if measured else None,
        database=given.database,
        resume=given.resume,
    )


if __name__ == "__main__":
    main()
