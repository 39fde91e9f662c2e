"""The streaming form: ticks → bars → averages and signals → tables.

Stream time here is Spark's watermark: one clock for the whole query, moved
between micro-batches. An event that is late only with respect to events of its
own micro-batch is still counted; ``operators.bars.drop_late`` and
:mod:`tickloom.streaming.exact` keep the per-partition, per-event rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.bars import recency
from tickloom.operators.ema import advisories, averages
from tickloom.schemas import BAR_SIZE, EMA_PERIODS, POINT, REGISTRY
from tickloom.session import STATE_STORE
from tickloom.sources.tables import write_batch

STATE = T.StructType([T.StructField("fast", T.DoubleType()), T.StructField("slow", T.DoubleType())])


def stream_bars(ticks: DataFrame, size: str = BAR_SIZE, grace: str = "0 seconds") -> DataFrame:
    """Closed bars of a tick stream: emitted once, when the watermark passes the window's end."""
    return (
        ticks.withWatermark("event_ts", grace)
        .groupBy("symbol", F.window("event_ts", size).alias("w"))
        .agg(F.max_by("price", recency(ticks)).alias("close"))
        .select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "close")
    )


# Bars of one symbol that are sorted in memory; more of them wait in keyed state, a day at a time.
SORTED_BARS = 20_000


class CrossoverProcessor(StatefulProcessor):
    """Keeps both averages of a symbol and emits one point per closed bar.

    A call sees the bars of one symbol that closed in one micro-batch, in any order. Up to ``limit`` of them are sorted in
    memory. When there are more, as in the backfill of a year, all of them are put into keyed state by day and taken from
    it day by day, so that a task holds one day's bars and the days' numbers.
    """

    def __init__(self, fast: int = EMA_PERIODS[0], slow: int = EMA_PERIODS[1], limit: int = SORTED_BARS):
        self.periods, self.limit = (fast, slow), limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.averages = handle.getValueState("averages", STATE)
        self.waiting = handle.getMapState("waiting", "day int", "starts array<bigint>, ends array<bigint>, closes array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        days: set[int] = set()
        for bars in rows:
            held.append(bars)
            if days or sum(map(len, held)) > self.limit:
                self._wait(pd.concat(held), days)
                held = []
        if not days:
            yield self._points(key[0], pd.concat(held))
            return
        if held:
            self._wait(pd.concat(held), days)
        for day in sorted(days):
            starts, ends, closes = self.waiting.getValue((day,))
            self.waiting.removeKey((day,))
            bars = pd.DataFrame({"window_start": pd.to_datetime(starts), "window_end": pd.to_datetime(ends), "close": closes})
            yield self._points(key[0], bars)

    def _wait(self, bars: pd.DataFrame, days: set[int]) -> None:
        nanos = {c: bars[c].astype("datetime64[ns]").astype("int64").to_numpy() for c in ("window_start", "window_end")}
        day_of = nanos["window_start"] // 86_400_000_000_000
        for day in np.unique(day_of).tolist():
            own = day_of == day
            more = [nanos["window_start"][own].tolist(), nanos["window_end"][own].tolist(), bars["close"].to_numpy(float)[own].tolist()]
            if day in days:
                more = [list(before) + now for before, now in zip(self.waiting.getValue((day,)), more)]
            self.waiting.updateValue((day,), tuple(more))
            days.add(day)

    def _points(self, symbol: str, bars: pd.DataFrame) -> pd.DataFrame:
        points = bars.sort_values("window_start").assign(symbol=symbol)
        state = tuple(self.averages.get()) if self.averages.exists() else (0.0, 0.0)
        closes = points["close"].to_numpy(float)
        found = [averages(closes, period, start) for period, start in zip(self.periods, state)]
        self.averages.update(tuple(float(x[-1]) for x in found))
        (fast0, fast), (slow0, slow) = ((x[:-1], x[1:]) for x in found)
        crossed = np.full(len(closes), None, dtype=object)
        crossed[(fast > slow) & (fast0 <= slow0)] = "BUY"
        crossed[(fast < slow) & (fast0 >= slow0)] = "SELL"
        return points.assign(ema38=fast, ema100=slow, signal=crossed)[POINT.fieldNames()]

    def close(self) -> None:
        pass


class FirstSeenProcessor(StatefulProcessor):
    """Lets a symbol out once, as it first arrived; one flag per symbol is all it keeps."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "known boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.known.exists():
            first = min(rows, key=lambda row: row.arrival)
            self.known.update((True,))
            yield Row(symbol=key[0], security_type=first.security_type or "", first_seen=first.event_ts)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.known.update((True,))

    def close(self) -> None:
        pass


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first arrival of each symbol in a batch: what a symbol with very many ticks sends on is a row per batch."""
    for batch in batches:
        arrival = batch.column("arrival")
        parts = [arrival] if not pa.types.is_struct(arrival.type) else arrival.flatten()
        names = [f"p{n}" for n in range(len(parts))]
        order = pc.sort_indices(
            pa.table([batch.column("symbol"), *parts], names=["symbol", *names]), sort_keys=[(n, "ascending") for n in ("symbol", *names)]
        )
        symbols = pc.take(batch.column("symbol"), order).to_pylist()
        firsts = [n for n, symbol in enumerate(symbols) if n == 0 or symbol != symbols[n - 1]]
        yield batch.take(order.take(pa.array(firsts, pa.int64())))


def stream_registry(ticks: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """New symbols of a tick stream, each once: what is known is keyed state, so a micro-batch reads nothing but its ticks.

    ``known`` are symbols registered before the stream's first checkpoint, for instance the stored registry.
    """
    for key, value in STATE_STORE.items():
        ticks.sparkSession.conf.set(key, value)
    rows = ticks.where("symbol IS NOT NULL").select("symbol", "security_type", "event_ts", "arrival")
    firsts = rows.mapInArrow(_first_of_each, rows.schema)
    return firsts.groupBy("symbol").transformWithState(
        statefulProcessor=FirstSeenProcessor(), outputStructType=REGISTRY, outputMode="Append", timeMode="None",
        initialState=None if known is None else known.select("symbol").distinct().groupBy("symbol"),
    )


def _started_by(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every``: how long micro-batches wait for each other. Longer means fewer commits and later results."""
    return writer if every is None else writer.trigger(processingTime=every)


def stream_points(ticks: DataFrame, size: str = BAR_SIZE, grace: str = "0 seconds") -> DataFrame:
    """History points of a tick stream (chained stateful stages, append mode, state in RocksDB)."""
    for key, value in STATE_STORE.items():
        ticks.sparkSession.conf.set(key, value)
    return stream_bars(ticks, size, grace).groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=CrossoverProcessor(), outputStructType=POINT, outputMode="Append", timeMode="None"
    )


def write_points(points: DataFrame, out: str, checkpoint: str, every: str | None = None) -> DataStreamWriter:
    """One pass, two tables: every point to ``history`` (by day), the signals also to ``advisories``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch, f"{out}/history", batch_id, by_day="window_start")
            write_batch(advisories(batch), f"{out}/advisories", batch_id)
        finally:
            batch.unpersist()

    return _started_by(points.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store), every)


def write_registry(
    ticks: DataFrame, out: str, checkpoint: str, known: DataFrame | None = None, every: str | None = None
) -> DataStreamWriter:
    """Each symbol once, as it first arrived, in a table by micro-batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/symbols", batch_id)

    return _started_by(stream_registry(ticks, known).writeStream.option("checkpointLocation", checkpoint).foreachBatch(store), every)
