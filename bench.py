"""Time the headline queries and print one JSON line.

The folder of tables is ``BENCH_SF_DIR``, the number of local cores ``BENCH_CPUS``. Rows go to
a sink that discards them; input files are written before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from sondelake.operators.scratch import scratch_path
from sondelake.plans.ingest import ingest
from sondelake.plans.lake import Lake
from sondelake.plans.publish import publish
from sondelake.schemas import seed_control
from workload import inputs
from workload.queries import JOB, QUERIES

HEADLINE = (
    "band_counts",
    "full_load",
    "delta_load",
    "header_decode",
    "level_decode",
    "block_scan_levels",
    "level_count_gate",
    "uid_first_wins",
    "serial_numbers",
    "csv_roundtrip",
    "partitioned_roundtrip",
)


def drain(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sondelake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or [*HEADLINE, "ingest", "publish"]

    messy = inputs.sounding_files(spark, sf_dir, messy=True)
    inputs.sounding_files(spark, sf_dir, messy=False)
    drain(QUERIES["band_counts"](spark, sf_dir))  # first use of the session

    seconds = {}
    for name in chosen:
        if name in QUERIES:
            seconds[name] = timed(lambda: drain(QUERIES[name](spark, sf_dir)))
    if "ingest" in chosen:
        lake = Lake(spark, scratch_path(spark, "lake"))
        seconds["ingest"] = timed(lambda: ingest(lake, messy, "first"))
        if "publish" in chosen:
            lake.control.replace(seed_control(spark, JOB))
            seconds["publish"] = timed(lambda: publish(lake, JOB))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
