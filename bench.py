"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and print one JSON line.

The raw trips are written to a Parquet file first, so that the timings are of the engine's own scans and not of the
fixture that makes trips out of events.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fareline import fixtures  # noqa: E402
from fareline.queries import QUERIES  # noqa: E402
from fareline.session import build_session  # noqa: E402
from fareline.sources.scratch import new_scratch_dir  # noqa: E402

# query -> timed repetitions after one untimed run
HEADLINES = {
    "conform_counts": 3,
    "conformed_trips": 3,
    "rejected_trips": 3,
    "reason_codes": 3,
    "fact_trips": 3,
    "agg_hourly_demand_by_zone": 3,
    "agg_monthly_zone_revenue": 3,
    "agg_monthly_data_quality": 3,
    "agg_monthly_pipeline_health": 3,
    "quality_profile": 3,
    "percentiles": 3,
    "duration_percentiles": 3,
    "orphan_locations": 3,
    "multi_month_union": 1,
    "replace_period": 1,
    "monthly_run": 1,
}


def seconds(spark, name: str, sf_dir: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("fareline-bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    prepared = f"{new_scratch_dir(spark, 'bench')}/raw"
    fixtures.raw_trips(spark, sf_dir).write.parquet(prepared)
    fixtures.raw_trips = lambda session, _: session.read.parquet(prepared)
    timings = {}
    for name, repetitions in HEADLINES.items():
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(repetitions)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
