"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up, then three timed runs into Spark's ``noop`` sink (the
full plan executes, nothing is collected); the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "p7_merged_items",
    "a12_period_table_weekly",
    "a12_period_table_daily",
    "f9_model_table_weekly",
    "i5_imputed_weekly",
    "w8_item_price_changes",
    "a20_category_table",
    "a23_summarize_period_table",
    "e2_pearson_corr",
    "b10_compare_lag_models",
]


def main() -> None:
    from demandflow.plans.queries import QUERIES
    from demandflow.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    timings = {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()       # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    conf = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
                                                 "spark.sql.adaptive.skewJoin.enabled", "spark.driver.memory")}
    print(json.dumps({"metric": "median_query_seconds_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "runs": runs, "conf": conf}))


if __name__ == "__main__":
    main()
