"""Benchmark the headline models and KPIs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pluvial.catalog import QUERIES  # noqa: E402
from pluvial.session import build_session  # noqa: E402

HEADLINE = (
    "fct_encounters",
    "dim_conditions",
    "dim_weather",
    "dim_dates",
    "dim_patients",
    "k_pain_patients_by_region",
    "k_rainy_pain_patients_by_region",
    "k_rainy_day_share",
    "k_top_diagnoses_by_region",
    "k_fact_diagnosis_region",
    "k_fact_pain_weather_analysis",
    "k_rain_effect",
    "k_weather_correlation",
    "k_icd_validation",
    "weather_request_plan",
    "upsert_ignore",
    "hierarchy_bfs",
    "dq_report",
)


def bundle_ingest(spark, sf_dir):
    """The shipped job, ``load_bundles``, on bundles landed beforehand (landing is
    not timed: it only synthesizes the input from the given tables)."""
    from pluvial.plans import jobs
    from pluvial.session import scratch_path
    from pluvial.sources import bundles as B
    from pluvial.sources.derived import RawLayer

    raw = RawLayer(spark, sf_dir)
    landing = B.write_bundles(raw.patients, raw.encounters, raw.conditions,
                              scratch_path(spark, "bench-bundles"))
    return lambda: jobs.load_bundles(spark, landing, scratch_path(spark, "bench-raw"), "1",
                                     layout="lines", glob="*.txt")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8),
                          app_name="pluvial-bench")
    # warm the JVM (class loading, codegen caches) on the smallest input
    warm = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    for name in ("fct_encounters", "k_pain_patients_by_region"):
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    run = bundle_ingest(spark, sf_dir)
    t0 = time.perf_counter()
    run()
    times["bundle_ingest"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
