"""Headline benchmark: prints one JSON line with per-query seconds.

Runs the main queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS].  Each query is fully executed with a no-op sink (no
result transfer to the driver); the value is the sum of the query times.
build_sec is the part of each time that passes before the final action.
landing_sec is the time to land the feed, which no query's time contains.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["sales_fact", "pareto_from_fact", "pareto_abc", "dedup_last", "sales_with_cost",
            "sales_with_settlement", "catalog_agg", "settlement_agg", "order_items_flatten",
            "missing_months", "pareto_table_text"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from salesabc.plans.registry import QUERIES, landed_feed
    from salesabc.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="salesabc-bench", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up: JVM, code paths and file listing, on the smallest query; the feed is landed once, as an input, timed apart.
    QUERIES["catalog_agg"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    t0 = time.perf_counter()
    landed_feed(spark, sf_dir)
    landing = round(time.perf_counter() - t0, 3)
    times, build = {}, {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        build[name] = round(time.perf_counter() - t0, 3)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "build_sec": build, "landing_sec": landing, "sf": sf}))


if __name__ == "__main__":
    main()
