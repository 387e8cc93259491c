"""Times the headline queries and prints one JSON line.

Every query is run whole into the noop sink. One untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martworks.catalog import QUERIES
from martworks.session import build_session

HEADLINE = [
    "rfm_segments", "ntile_distributed", "latest_status", "shipping_status", "shipping_datamart", "calendar_age",
    "fact_sales", "customer_retention", "settlement_report", "courier_ledger", "global_metrics", "group_conversion",
    "geo_events", "nearest_city_by_cells", "user_mart", "travel_list", "geo_zone_mart", "recommendation_mart",
    "upsert_rows", "insert_ignore", "hub_load", "link_load", "satellite_changes", "product_sales_fact", "fact_deliveries",
    "enrich_items", "order_vault_links", "user_product_counters", "scd_validity", "dense_ids", "time_dimension",
    "quality_violations", "campaign_stream", "counters_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("quality_uniqueness")
    times = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
