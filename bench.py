"""Seconds per headline query; one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.plans.queries import QUERIES  # noqa: E402
from tickloom.session import build_session  # noqa: E402

HEADLINE = (
    "bars_5m",
    "bars_closed_only",
    "ema_points",
    "advisories",
    "ema_by_day",
    "symbol_registry",
    "late_totals",
    "late_percentiles",
    "counterfactual_compare",
    "ingest_classify",
    "window_crossings",
    "second_totals",
    "minute_totals",
    "symbol_totals",
    "symbol_stats",
    "concentration",
    "price_ranking",
    "counter_rate",
    "total_on_ticks",
    "latency_summary",
    "stream_points",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["ema_points"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start workers, warm the JVM
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "ticks_per_second": {n: round(events / seconds[n]) for n in ("ema_points", "stream_points") if n in seconds},
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
