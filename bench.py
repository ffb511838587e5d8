"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up the JVM and once for the clock. The clock covers building the plan
and producing every row (to Spark's no-op sink).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from oreflow.session import tuned  # noqa: E402
from workload.catalog import queries  # noqa: E402

HEADLINE = (
    "bronze_row_hash",
    "std_full_transactions",
    "val_valid_rows_transactions",
    "val_transform_audit",
    "val_reject_union",
    "gold_customer_360",
    "gold_daily_summary",
    "gold_account_transactions",
    "gold_product_performance",
    "gold_dq_dashboard",
    "ml_feature_table",
    "triage_table",
    "rpt_segment_summary",
    "gate_report",
    "full_refresh",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        tuned(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
