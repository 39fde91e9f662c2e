"""Throughput of the tick stream over many micro-batches: python bench_stream.py TICKS BATCHES; prints one JSON line.

The ticks are in order, of 500 symbols, one of which holds a third of them; a micro-batch is one file of two hours.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from tickloom.session import build_session
from tickloom.streaming import crossover

SYMBOLS, HOURS, START = 500, 2, 1_636_329_600


def main(ticks: int, batches: int) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("stream", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="stream-")
    symbol = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(SYMBOLS)))
    rows = spark.range(0, ticks, 1, batches).select(
        F.format_string("S%04d", symbol).alias("symbol"),
        (F.lit(100.0) + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("price"),
        F.timestamp_micros(F.expr(f"CAST({START}000000 + id * {HOURS * 3600_000000 * batches / ticks} AS BIGINT)")).alias("event_ts"),
        F.col("id").alias("arrival"),
    )
    rows.write.parquet(f"{out}/ticks")
    for n, name in enumerate(sorted(f for f in os.listdir(f"{out}/ticks") if f.startswith("part-"))):
        os.utime(f"{out}/ticks/{name}", (START + n, START + n))  # the source takes files by their time
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/ticks")
    begun = time.time()
    points = crossover.stream_points(source)
    run = crossover.write_points(points, out, f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    seconds = time.time() - begun
    took = [p["batchDuration"] for p in run.recentProgress if p["numInputRows"]]
    quarter = max(1, len(took) // 4)
    print(
        json.dumps(
            {
                "metric": "stream_points", "ticks": ticks, "batches": len(took), "value": round(seconds, 2), "unit": "sec",
                "ticks_per_second": round(ticks / seconds), "points": spark.read.parquet(f"{out}/history").count(),
                "batch_ms": {"median": sorted(took)[len(took) // 2], "max": max(took)},
                "batch_ms_by_quarter": [round(sum(took[i : i + quarter]) / quarter) for i in range(0, quarter * 4, quarter)],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]), int(sys.argv[2]))
