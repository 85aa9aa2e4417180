"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Every query is run to its
last row into the no-op sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import time

from tallystock import catalog
from tallystock.session import build_session

HEADLINE = [
    "kpi_ira", "kpi_stockout", "expiry_risk", "pb01_ira_ranked", "pb02_discrepancies", "pb03_stockout_total",
    "pb04_expiring_stock", "pb05_brand_share", "pb06_pending_running", "dashboard", "critical_share",
    "build_fact_inventory", "build_fact_discrepancy", "build_movements", "build_product_master", "ageing_light",
    "flags_main", "flags_movements", "rule_code", "fill_down", "warnings", "classify_category", "scd2_merge",
    "change_journal", "constraint_checks", "running_total", "enumerate_rows", "dedupe_files_md5",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["kpi_ira"](spark, sf_dir).count()  # start-up, not counted
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1)) if found else None}))
    spark.stop()


if __name__ == "__main__":
    main()
