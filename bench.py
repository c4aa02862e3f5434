"""Time the headline queries and print one JSON line.

Every query is run completely (all rows are produced and dropped by the noop sink): once cold and three times warm. The
value is the sum of the warm medians. BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from rowmill.plans import all_queries

HEADLINES = [
    "project",
    "filter",
    "filter_params",
    "execute_named",
    "chain_filter_sort",
    "recent_interval",
    "json_contains",
    "array_ops",
    "avg_by_group",
    "count_all",
    "top_k",
    "window",
    "window_running",
    "report_join",
    "sql_left_join",
    "sql_rollup",
    "insert",
    "update",
    "update_partitioned",
    "delete",
    "execute_many",
    "constraint_check",
    "infer_sqlite",
    "infer_input",
    "map_types",
    "scan_jdbc",
    "insert_jdbc",
    "scan_sqlite",
    "copy_table",
    "read_all",
    "sql_dump",
]
WARM_RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    first, warm = {}, {}
    for name in HEADLINES:
        times = []
        for _ in range(1 + WARM_RUNS):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        first[name], warm[name] = round(times[0], 3), round(statistics.median(times[1:]), 3)
        print(name, first[name], warm[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "sum of warm median seconds over headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "first_run": first,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
