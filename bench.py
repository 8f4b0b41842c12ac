"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` is the folder of the driver tables, ``BENCH_CPUS`` the number of local
cores. The tables a query reads are written before its clock starts; ``build_star`` is the
time it takes to write all of them. Each query runs once to warm up and then
``BENCH_RUNS`` times (3); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmart.catalog.derive import shop  # noqa: E402
from sparkmart.catalog.registry import QUERIES  # noqa: E402
from sparkmart.session import local_session  # noqa: E402

HEADLINE = (
    "a1_gross_revenue",
    "a1_gross_revenue_per_version",
    "a2_revenue_by_category",
    "a4_returned_quantity",
    "a5_products_by_color",
    "a6_margin_by_subcategory",
    "p1_staged_sales_log",
    "m1_latest_state",
    "m10_sales_increment",
    "j1_asof_join",
    "j1_asof_join_salted",
    "m2_upsert",
    "m4_scd2_from_history",
    "m4_scd2_events",
    "m8_dim_products",
    "m11_dim_customers",
    "s14_snapshot_diff",
    "q5_returned_before_ordered",
    "q9_all_checks",
    "t1_cdc_stream",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8))
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    star = shop(spark, directory).star
    build = time.perf_counter() - start
    assert star.sales is not None

    timings = {"build_star": round(build, 3)}
    for name in HEADLINE:
        measured = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(measured[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
