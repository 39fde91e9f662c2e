"""The streaming form with the exact late rule: one clock per input partition, moved by every event.

Each micro-batch runs the batch operators and hands three small tables to the
next one: the partitions' clocks, the bars still open, and every symbol's last
averages. They are stored below ``out/state`` under the batch's number; a batch
that runs again reads its predecessor's version and overwrites its own, so the
result does not depend on failures or on where micro-batches are cut. The last
two versions are kept, and a version that is needed but missing is an error:
only batch 0 starts empty. No micro-batch lists or reads the history. Inside a
micro-batch ``arrival`` orders the ticks; a later micro-batch arrives later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.bars import recency, with_stream_time
from tickloom.operators.ema import advisories, ema_points
from tickloom.schemas import BAR_SIZE, EMA_PERIODS
from tickloom.sources.tables import remove, write_batch

CLOCKS = "partition INT, clock TIMESTAMP"
OPEN = "symbol STRING, partition INT, window_start TIMESTAMP, window_end TIMESTAMP, close DOUBLE, last_ts TIMESTAMP"
AVERAGES = "symbol STRING, window_start TIMESTAMP, ema38 DOUBLE, ema100 DOUBLE"
POINTS = (
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, close DOUBLE, ema38 DOUBLE, ema100 DOUBLE, signal STRING"
)
_BAR = ["symbol", "partition", "window_start", "window_end"]


def advance_clocks(clocks: DataFrame, ticks: DataFrame) -> DataFrame:
    seen = ticks.groupBy("partition").agg(F.max("event_ts").alias("clock"))
    return clocks.unionByName(seen).groupBy("partition").agg(F.max("clock").alias("clock"))


def on_time(ticks: DataFrame, clocks: DataFrame, size: str = BAR_SIZE) -> DataFrame:
    """Ticks that are late neither within the batch nor against the clocks left by earlier ones."""
    marked = with_stream_time(ticks, size).where(~F.col("late"))
    known = marked.join(clocks, "partition", "left")
    return known.where(F.col("clock").isNull() | (F.col("window_end") > F.col("clock")))


def merge_bars(kept: DataFrame, waiting: DataFrame) -> DataFrame:
    """Bars of this batch laid over the bars still open; on equal event times the newer batch wins."""
    fresh = kept.groupBy(*_BAR).agg(F.max_by("price", recency(kept)).alias("close"), F.max("event_ts").alias("last_ts"))
    both = fresh.withColumn("age", F.lit(1)).unionByName(waiting.withColumn("age", F.lit(0)))
    latest = F.struct("last_ts", "age")
    return both.groupBy(*_BAR).agg(F.max_by("close", latest).alias("close"), F.max("last_ts").alias("last_ts"))


def points_from(closed: DataFrame, averages: DataFrame) -> DataFrame:
    """Points of newly closed bars, going on from each symbol's stored averages."""
    starts = {p: f"start{p}" for p in EMA_PERIODS}
    stored = averages.select("symbol", *[F.col(f"ema{p}").alias(c) for p, c in starts.items()])
    joined = closed.select("symbol", "window_start", "window_end", "close").join(stored, "symbol", "left")
    return ema_points(joined.fillna(0.0, list(starts.values())), starts=starts)


def newest_averages(averages: DataFrame, points: DataFrame) -> DataFrame:
    columns = ["symbol", "window_start", "ema38", "ema100"]
    both = averages.select(*columns).unionByName(points.select(*columns))
    newest = [F.max_by(c, "window_start").alias(c) for c in columns[2:]]
    return both.groupBy("symbol").agg(F.max("window_start").alias("window_start"), *newest)


def process(ticks: DataFrame, batch_id: int, out: str, size: str = BAR_SIZE) -> None:
    """One micro-batch: read the previous state, write points, advisories and the next state."""
    spark = ticks.sparkSession
    old, new = f"{out}/state/{batch_id - 1}", f"{out}/state/{batch_id}"

    def before(name: str, schema: str) -> DataFrame:
        return spark.createDataFrame([], schema) if batch_id == 0 else spark.read.schema(schema).parquet(f"{old}/{name}")

    def after(frame: DataFrame, name: str, schema: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{new}/{name}")
        return spark.read.schema(schema).parquet(f"{new}/{name}")

    clocks, waiting, averages = before("clocks", CLOCKS), before("open", OPEN), before("averages", AVERAGES)
    # Every table below is written once and read back, so nothing is computed twice.
    now = after(advance_clocks(clocks, ticks).coalesce(1), "clocks", CLOCKS)
    merged = merge_bars(on_time(ticks, clocks, size), waiting)
    marked = merged.join(now, "partition").withColumn("closed", F.col("window_end") <= F.col("clock")).drop("clock")
    bars = after(marked, "bars", f"{OPEN}, closed BOOLEAN")
    after(bars.where(~F.col("closed")).drop("closed"), "open", OPEN)
    points = after(points_from(bars.where("closed"), averages), "points", POINTS)
    write_batch(points, f"{out}/history", batch_id, by_day="window_start")
    write_batch(advisories(points), f"{out}/advisories", batch_id)
    after(newest_averages(averages, points), "averages", AVERAGES)
    remove(spark, f"{out}/state/{batch_id - 2}")


def write_exact_points(ticks: DataFrame, out: str, checkpoint: str, size: str = BAR_SIZE) -> DataStreamWriter:
    """A stream of ticks into ``out/history`` and ``out/advisories``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            process(batch, batch_id, out, size)
        finally:
            batch.unpersist()

    return ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
