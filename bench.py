"""Headline queries on the tables in $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import build_session  # noqa: E402
from tidemark.workload import all_queries  # noqa: E402

HEADLINES = [
    "v1_brand_stock", "v2_category_flows", "v3_store_daily_sales", "v4_availability_daily_sales", "v5_site_daily_summary",
    "v6_counter_revenue", "v7_category_estimate", "v8_review_proxy_summary", "v9_target_share", "v10_partner_medians",
    "v11_monthly_trend", "v12_report_rows", "v13_lot_tenders", "v14_source_price_stats", "v15_listing_ranks", "v16_new_brand_log",
    "a9_rollups_in_one_pass", "k1_insert_absent", "k2_upsert", "w7_stitch_chunks",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "tidemark-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in HEADLINES:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, best of runs, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"), "median": round(statistics.median(seconds.values()), 3),
    }))


if __name__ == "__main__":
    main()
