"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full with the ``noop`` sink (every row produced, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pricepanel.plans.queries import QUERIES  # noqa: E402
from pricepanel.session import drop_scratch, get_session  # noqa: E402

HEADLINE = [
    "sales_competitor_join",      # entry A: outlier filter -> dedupe -> pivot -> merge
    "price_outlier_filter",
    "product_day_rollup",         # entry C: receipts -> product-day panel with store counts
    "store_follower_select",
    "weekly_resample",
    "cpi_adjust_base_year",
    "holiday_distance",
    "resimulated_features",       # entry B: grid expansion + feature recompute
    "price_grid",
    "quality_tiers",              # curves -> arc elasticity -> dispersion -> tiers
    "category_elasticity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    # warm-up: JVM JIT, file listing caches and the Arrow/pandas Python workers (one-time costs)
    QUERIES["overview_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    (spark.range(0, 10000, numPartitions=cpus).groupBy((F.col("id") % (cpus * 4)).alias("g"))
     .applyInPandas(lambda pdf: pdf[["id"]], "id long").write.format("noop").mode("overwrite").save())
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
