"""Time the headline jobs: prints one JSON line.

The grants-shaped input tables are written as Parquet first, as the jobs would
find them; that time is reported apart as ``prepare_sec``. Each job is written to
Spark's no-op sink, so all rows and columns are computed.
BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks import CHECKS
from checks.views import VIEWS, Views
from fundlens.session import staging_path, with_settings
from fundlens.sources.writers import write_files

HEADLINES = [
    "t1_base_donations",
    "t2_matching_payouts_per_order",
    "t3_all_donations",
    "t4_all_matching",
    "t5_historical_donations",
    "t6_historical_matching",
    "t7_gmv_events",
    "t7d_donation_operators",
    "t8_round_totals",
    "t9_project_groups_summary",
    "c1_flatten_scores",
    "c3_sign_events",
    "j5_range_join",
    "j13_group_totals",
    "f14_row_hash",
    "f17_normalize_title",
]


class StagedViews(Views):
    """Views that were written once and are read from their files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        for name in VIEWS:
            self._frames[name] = write_files(self._build(name), staging_path(spark, name))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", cpus)
    spark = with_settings(builder.config("spark.driver.memory", "16g")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINES
    start = time.perf_counter()
    views = StagedViews(spark, sf_dir)
    prepared = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        CHECKS[name][0](views).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "prepare_sec": prepared,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
