"""Lag and throughput of running queries as rows."""

from __future__ import annotations

from threading import Event, Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tickloom.operators.ingest import ACCEPTED, REJECTED, SKIPPED
from tickloom.sources.tables import read_table

PROGRESS = (
    "query STRING, batch_id BIGINT, timestamp STRING, input_rows BIGINT, input_rate DOUBLE, "
    "processed_rate DOUBLE, late_rows BIGINT, state_rows BIGINT, watermark STRING, "
    "accepted BIGINT, skipped BIGINT, rejected BIGINT"
)


def progress_row(progress) -> tuple:
    """One row per micro-batch; late rows are those the watermark dropped.

    Rows accepted, skipped and rejected are there when the query reads ``ingest.observed`` rows, else NULL.
    """
    states = progress.stateOperators
    seen = next((row for row in progress.observedMetrics.values() if ACCEPTED in row), None)
    return (
        progress.name or str(progress.id),
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        float(progress.inputRowsPerSecond),
        float(progress.processedRowsPerSecond),
        sum(s.numRowsDroppedByWatermark for s in states),
        sum(s.numRowsTotal for s in states),
        dict(progress.eventTime).get("watermark"),
        *((seen[s] if seen else None) for s in (ACCEPTED, SKIPPED, REJECTED)),
    )


class ProgressLog(StreamingQueryListener):
    """Writes one row per micro-batch to a table; only rows not yet written are held, at most ``every`` of them."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.waiting: list[tuple] = []
        self.lock = Lock()
        self.ended = Event()  # set when a query has ended and its rows are written

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(progress_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self.ended.set()

    def add(self, row: tuple) -> None:
        with self.lock:
            self.waiting.append(row)
            full = len(self.waiting) >= self.every
        if full:
            self.flush()

    def flush(self) -> None:
        """Append what is waiting; rows stay waiting when the write fails."""
        with self.lock:
            if self.waiting:
                rows = self.spark.createDataFrame(self.waiting, PROGRESS)
                rows.coalesce(1).write.mode("append").parquet(self.path)
                self.waiting = []

    def frame(self) -> DataFrame:
        """Every micro-batch reported so far."""
        self.flush()
        return read_table(self.spark, self.path, PROGRESS)
