"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
(default 8).  Each query is built and fully executed with the ``noop`` sink
(no rows are collected to the driver): one warm-up, then the median of
$BENCH_RUNS runs (default 3).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.operators import catalog  # noqa: E402
from quarry.plans import registry  # noqa: E402
from quarry.session import build_session  # noqa: E402

HEADLINE = [
    "cte_multi",
    "join_left_aggregate",
    "join_full",
    "agg_top_products",
    "agg_monthly_sales",
    "agg_month_cumulative",
    "agg_having_stddev",
    "win_rank",
    "win_running_sum",
    "win_lead_lag",
    "subq_correlated",
    "dedup_by_key",
    "set_except",
    "arr_split_explode",
    "str_case",
    "sink_partitioned_many",
    "scan_pruned_partitions",
    "ver_scan",
    "ver_as_of_version",
    "etl_schema_discovery",
    "etl_job",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        master=f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="quarry-bench", driver_memory="16g"
    )
    qs = registry.queries()
    timings: dict[str, float] = {}
    for name in names:
        fn = qs[name]
        run_once(spark, fn, sf_dir)  # warm-up (also builds write-once inputs)
        timings[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
        catalog.drop_work_database(spark)  # the query's numbered tables, now that its results are out
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
