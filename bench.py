"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query's result is consumed
by the ``noop`` sink, so the timing covers the whole plan and no driver collect.
The query list runs once on the smallest tables first (JVM warm-up, not counted).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeload.plans import catalog  # noqa: E402
from lakeload.session import get_session  # noqa: E402

HEADLINE = [
    "billing_for_each_customer",
    "gold_candidate_by_campaign",
    "gold_status_by_campaign",
    "merge_cdc",
    "merge_cdc_metrics",
    "merge_cdc_shuffle",
    "merge_full",
    "merge_composite_key",
    "change_feed",
    "merge_latest_per_key",
    "dq_report",
    "cdc_load_silver",
    "cdc_load_collapsed",
    "load_log_full",
]


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    event_log = os.environ.get("BENCH_EVENT_LOG")  # a scratch folder for stage / task times
    extra = {}
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log}
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), extra_conf=extra)
    names = sys.argv[1:] or HEADLINE
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):  # JVM / code-generation warm-up on the smallest tables
        for name in names:
            try:
                run(spark, name, warm)
            except Exception:  # noqa: BLE001 - the timed run below reports failures
                pass
    times, errors = {}, {}
    for name in names:
        try:
            times[name] = round(run(spark, name, sf), 3)
        except Exception as exc:  # noqa: BLE001 - keep timing the other queries
            times[name] = None
            errors[name] = str(exc).splitlines()[0][:200]
    sf_value = sf.rsplit("sf", 1)[-1]
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf_value) if sf_value.replace(".", "", 1).isdigit() else sf,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))


if __name__ == "__main__":
    main()
