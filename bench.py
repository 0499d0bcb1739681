"""Seconds per headline query on one machine; prints one JSON line.

The warehouse is built once from the raw tables (``etl_build``), as in production; the KPI,
report and check queries then read it. Cleaning and profiling start from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

from orderloom import catalog, testdata
from orderloom.plans import kpis, warehouse
from orderloom.session import fresh_path, local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))

HEADLINE = [
    *kpis.KPIS,
    "rollup_supplier",
    "rollup_monthly",
    "rollup_regional",
    "rollup_shipping",
    "refresh_monthly",
    "refresh_regional",
    "chk_totals",
    "chk_segment_performance",
    "chk_yearly_summary",
    "exec_cards",
    "supplier_table",
    "monthly_margin_trend",
    "daily_order_volume",
    "dq_health_report",
    "dq_fk_orphans",
    "enrich_orders",
    "profile_columns",
    "profile_nulls",
    "fill_numeric_median",
    "standardize_text",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def spread(spark) -> str:
    """The raw tables in as many files as there are cores, as a cluster's input would be; the given ones are single files."""
    folder = fresh_path(spark, "bench-input")
    for name in ("lineitem", "orders", "customer", "part", "nation", "region"):
        rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        rows.repartition(int(CPUS)).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    seconds = {}
    tables = spread(spark)
    # A small build first, so that the measured one does not pay for JVM start-up.
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.01")
    if os.path.isdir(small):
        warehouse.build_warehouse(spark, testdata.order_lines(spark, small), fresh_path(spark, "bench-warm-up"))
    seconds["etl_build"] = timed(lambda: catalog.warehouse_of(spark, tables))
    star = catalog.warehouse_of(spark, tables)
    seconds["raw_lines"] = timed(lambda: catalog.raw_of(spark, tables))
    for name in HEADLINE:
        query = catalog.QUERIES[name]
        seconds[name] = min(timed(lambda: run(query(spark, tables))) for _ in range(REPEATS))
    seconds["kpi_run_all_shared"] = timed(lambda: warehouse.run_kpis(spark, star, fresh_path(spark, "bench-kpis")))
    spark.stop()
    seconds = {k: round(v, 3) for k, v in seconds.items()}
    result = {
        "metric": "total seconds, warehouse build and headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    sys.stdout.write(json.dumps(result) + "\n")


if __name__ == "__main__":
    main()
