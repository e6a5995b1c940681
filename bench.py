"""Headline queries, timed one by one; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local cores. Every
query is executed completely (results go to the no-op sink); the session is warmed up on a scan.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cln01_keep_first", "cln11_clean_erp_orders", "cln15_clean_inventory", "jn03_point_in_time",
    "jn06_not_loaded_yet", "agg01_customer_metrics", "agg02_sales_metrics", "agg05_inventory_metrics",
    "dq08_medallion_suite", "dq11_scorecard_orders", "onb01_profile", "onb02_classify", "onb03_map_columns",
    "wh01_scd2_customers", "wh02_scd2_products", "wh04_calendar", "wh05_store_upsert", "wh06_fact_sales", "wh07_fact_orders",
    "wh08_fact_sales_current", "wh08_fact_orders_current", "aud03_overlaps",
    "aud06_integrity_suite",
    "rpt01_top_customers", "rpt02_revenue_by_month", "rpt10_inventory_board",
]


def main() -> None:
    from bazaarline.queries import QUERIES
    from bazaarline.session import get_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                        spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
