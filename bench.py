"""Headline queries at one scale; prints one JSON line.

Each query runs once to warm up, then REPEATS times; the median counts. Results are
written to Spark's no-op sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millwright.session import build_session  # noqa: E402
from workload import adapters  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "what_to_build", "product_cost_breakdown", "materials_for_builds", "materials_three_tier",
    "cheapest_region_for_keyword", "ore_ranking", "blueprint_pipeline", "practical_price", "part_price_listing",
    "order_depth_average", "order_depth_exact_steps", "bom_explode", "bom_rates", "bom_copy_runs",
    "product_breakeven", "xml_orders_sell", "xml_assets_nested", "price_upsert", "snapshot_replace",
    "upsert_parts", "keyword_explode", "constraint_violations", "stale_items",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(run) -> float:
        started = time.perf_counter()
        run()
        return time.perf_counter() - started

    # the stored layer under the reports (aggregates and exploded paths), timed on its own
    seconds = {"build_snapshot": round(timed(lambda: adapters.build_snapshot(spark, sf_dir)), 3)}
    adapters.snapshot(spark, sf_dir)
    for name in sys.argv[1:] or HEADLINE:
        def run(name=name):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(REPEATS)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cores": int(cpus),
        "repeats": REPEATS}))
    spark.stop()


if __name__ == "__main__":
    main()
