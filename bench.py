"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and fully executed with a ``noop`` sink (no driver collect), after one
warm-up query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.queries import API_PAGE_SIZE, QUERIES, landed, span  # noqa: E402
from strata.session import build_session  # noqa: E402

HEADLINE = [
    "gold_daily", "gold_kpis", "deduplicate", "deduplicate_lineitem", "enrich_dim",
    "enrich_nation", "dq_null_rate", "exp_suite_silver", "exp_unique", "dq_profile_silver",
    "scan_csv", "api_page_counts", "multi_source_bronze", "silver_roundtrip", "silver_pipeline",
    "gold_pipeline", "medallion_e2e", "backfill_range", "quality_stage", "dedup_report",
    "dq_partitions", "audit_log", "stream_bronze", "orders_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", app="strata-bench")
    QUERIES["gold_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    # The landing zones are input, not part of a query.
    landed(spark, sf_dir), landed(spark, sf_dir, API_PAGE_SIZE), span(spark, sf_dir)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
