"""Times the headline queries and prints one JSON line.

All queries are timed; the total is that of the headline ones. Each query runs once to warm up (class loading, code generation) and is then timed; the result goes to the
noop sink, so all rows are produced and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from meterdw.plans.queries import REGISTRY
from meterdw.session import build_session

# the text operators have a bench of their own: the check over larger documents that the README quotes

HEADLINE = [
    "dwd_device_meter_detail", "dwd_no_customer", "dwd_status_v4", "dwd_generated", "quick_monitor",
    "dws_device_hour", "dws_device_5min", "dws_device_hour_tumble", "dws_substation_hour",
    "dws_substation_hour_tumble", "dws_customer_hour", "dws_customer_hour_tou", "dws_device_30s",
    "dws_substation_30s", "dws_device_20s", "ads_device_realtime", "ads_substation_overview",
    "ads_substation_overview_batch", "alarm_statistics", "customer_power_statistics",
    "substation_hour_with_alarms", "dash_status_summary", "dash_window_stats", "monitor_counts",
    "cdc_apply_latest", "voltage_correction", "orphan_readings", "reconcile_hour",
    "stream_tumble_device", "stream_substation_30s", "stream_dwd_enrich",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
                          spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    timed = {}
    for name in sys.argv[1:] or HEADLINE + sorted(REGISTRY.keys() - set(HEADLINE)):
        run(REGISTRY[name], spark, folder)
        timed[name] = round(run(REGISTRY[name], spark, folder), 3)
    total = sum(s for n, s in timed.items() if n in HEADLINE or sys.argv[1:])
    streams = {n: round(rows / s) for n, s in timed.items() if n.startswith("stream_")}
    print(json.dumps({"metric": "headline_total", "value": round(total, 3), "unit": "sec", "queries": timed,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "readings": rows,
                      "stream_rows_per_sec": streams}))
    spark.stop()


if __name__ == "__main__":
    main()
