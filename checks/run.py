"""Compare all registered queries, or those whose name starts with an argument.

    python -m checks.run [--sf DIR] [prefix ...]
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

from checks import CHECKS
from checks.compare import differences, duckdb_connection
from checks.views import Views, duckdb_sql
from fundlens.session import with_settings


def main(args: list[str]) -> int:
    sf_dir = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf_dir = args[at + 1]
        args = args[:at] + args[at + 2 :]
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    spark = with_settings(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    failed = 0
    for name, (query, sql) in CHECKS.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            df = query(Views(spark, sf_dir))
            found = differences(df, con, duckdb_sql(sql)) if sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:900]}"
        failed += found is not None and not found.startswith("rows only")
        print(f"{name}: {found or 'equal'} ({time.time() - start:.1f} s)", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
