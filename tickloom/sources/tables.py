"""Parquet tables the streaming job writes: history, results, registry.

Every write is keyed by its micro-batch, so a batch that runs again after a
failure replaces its own rows instead of adding them twice.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.registry import new_symbols
from tickloom.operators.replay import replay_range
from tickloom.schemas import HISTORY_DAYS
from tickloom.sources import manifest
from tickloom.sources.manifest import remove  # noqa: F401  (part of this module's interface)


def write_batch(df: DataFrame, path: str, batch_id: int, by_day: str | None = None) -> None:
    """Store one micro-batch, optionally partitioned by the day of ``by_day``.

    The rebalance hint lets adaptive execution merge small files and split a
    large day.
    """
    stamped = df.withColumn("batch_id", F.lit(batch_id))
    keys = ["batch_id"]
    if by_day:
        stamped = stamped.withColumn("day", F.to_date(by_day)).hint("rebalance", "day")
        keys = ["day", "batch_id"]
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def store_ticks(ticks: DataFrame, path: str) -> None:
    """Ticks as Parquet by day, sorted by event time, so that range reads prune folders and row groups."""
    dated = ticks.withColumn("day", F.to_date("event_ts")).hint("rebalance", "day")
    ordered = dated.sortWithinPartitions("day", "event_ts")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """Per day folder a fingerprint of its files' names, sizes and times; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    day = F.regexp_extract("path", r"/day=(\d{4}-\d{2}-\d{2})/", 1).cast("date").alias("day")
    one = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime")
    # order must not count, and the 64 bits wrap
    return files.groupBy(day).agg(F.bit_xor(one).alias("fingerprint"))


def read_ticks(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Stored ticks with event time in ``[start, end)``; only the days in between are listed and read."""
    ticks = replay_range(spark.read.parquet(path), start, end)
    if start is not None:
        ticks = ticks.where(F.col("day") >= F.to_date(F.lit(start)))
    if end is not None:
        ticks = ticks.where(F.col("day") <= F.to_date(F.lit(end)))
    return ticks.drop("day")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table's rows, or no rows while nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# What a stored point consists of; ``day`` is the folder.
HISTORY = (
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, close DOUBLE, ema38 DOUBLE, ema100 DOUBLE, "
    "signal STRING, day DATE"
)


def _batches(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The micro-batches that have rows of a day, by day."""
    found: dict[str, list[int]] = {}
    for folder in manifest.listing(spark, f"{path}/day=*/batch_id=*"):
        day, batch = (part.partition("=")[2] for part in folder.split("/")[-2:])
        found.setdefault(day, []).append(int(batch))
    return found


def _points(spark: SparkSession, path: str, compacted: dict[str, manifest.Day], batches: dict[str, list[int]]) -> DataFrame:
    """History points of the given compacted days and of the given micro-batches of days."""
    parts = [
        (f"{path}_days", f"{HISTORY}, commit STRING", [f"{path}_days/commit={x.commit}/day={d}" for d, x in sorted(compacted.items())]),
        (path, f"{HISTORY}, batch_id BIGINT", [f"{path}/day={d}/batch_id={n}" for d, own in sorted(batches.items()) for n in own]),
    ]
    frames = [
        spark.read.schema(schema).option("basePath", base).parquet(*folders).drop("commit", "batch_id")
        for base, schema, folders in parts
        if folders
    ]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], HISTORY)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History points: the compacted days that the manifest names, and the micro-batches that it does not hold yet.

    Filters on ``day`` prune folders, filters on ``symbol`` skip files of a compacted day. The frame is the state at the
    time of the call; what a later compaction replaces is deleted by the one after that.
    """
    state = manifest.current(spark, path)
    live = {d: [n for n in own if not state.holds(d, n)] for d, own in _batches(spark, path).items()}
    return _points(spark, path, state.days, live)


def _write_days(points: DataFrame, folder: str) -> None:
    """One folder a day whose files hold ranges of symbols, each file sorted, with a Bloom filter of its symbols."""
    order = ("day", "symbol", "window_start")
    ordered = points.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.option("parquet.bloom.filter.enabled#symbol", "true").partitionBy("day").parquet(folder)


def compact_history(spark: SparkSession, path: str, until: date, days: int = HISTORY_DAYS) -> None:
    """Turn the micro-batch folders of the days before ``until`` into one folder a day, and let days expire.

    The new folders become part of the table when the manifest that names them is swapped in, in the last step; the folders
    they replace leave it in the same instant. So a compaction may be cut short anywhere: the table is the old one or the
    new one. Rows that come for a compacted day later are merged into it. Retention counts back from the newest compacted
    day. No window of a day before ``until`` may be open.
    """
    clean_history(spark, path)
    state = manifest.current(spark, path)
    ready = {d: [n for n in own if not state.holds(d, n)] for d, own in _batches(spark, path).items() if d < until.isoformat()}
    ready = {d: own for d, own in ready.items() if own}
    name = f"{state.version + 1}-{uuid.uuid4().hex}"
    if ready:
        earlier = {d: state.days[d] for d in ready if d in state.days}
        _write_days(_points(spark, path, earlier, ready), f"{path}_days/commit={name}")
    compacted = {**state.days, **{d: manifest.Day(name, max(own)) for d, own in ready.items()}}
    first = state.first
    if compacted:
        first = max(first, (date.fromisoformat(max(compacted)) - timedelta(days=days)).isoformat())
    compacted = {d: x for d, x in compacted.items() if d >= first}
    if (compacted, first) != (state.days, state.first):
        manifest.commit(spark, path, manifest.Manifest(state.version + 1, compacted, first))


def clean_history(spark: SparkSession, path: str) -> None:
    """Delete what the manifest does not name: replaced and expired folders, and those a compaction cut short has left.

    Every compaction begins with it, so what it replaces itself stays until the next one, for readers that have begun.
    """
    state = manifest.current(spark, path)
    for day, own in _batches(spark, path).items():
        held = [n for n in own if state.holds(day, n)]
        for folder in [f"{path}/day={day}"] if held == own else [f"{path}/day={day}/batch_id={n}" for n in held]:
            manifest.remove(spark, folder)
    named = {(x.commit, d) for d, x in state.days.items()}
    for folder in manifest.listing(spark, f"{path}_days/commit=*"):
        name = folder.rpartition("=")[2]
        if not any(commit == name for commit, _ in named):
            manifest.remove(spark, folder)
            continue
        for day in manifest.listing(spark, f"{folder}/day=*"):
            if (name, day.rpartition("=")[2]) not in named:
                manifest.remove(spark, day)
    manifest.forget_versions(spark, path)


def append_registry(found: DataFrame, path: str, batch_id: int) -> None:
    """Insert-only merge: symbols that no other batch registered. A batch without a new symbol leaves no folder."""
    schema = "symbol STRING, security_type STRING, first_seen TIMESTAMP, batch_id BIGINT"
    known = read_table(found.sparkSession, path, schema).where(F.col("batch_id") != batch_id)
    write_batch(new_symbols(found, known), path, batch_id)


def write_sparse_csv(frames: list[DataFrame], path: str) -> None:
    """Rows of different shapes in one CSV: the header is the union of their columns in first-seen order."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    merged.write.mode("overwrite").option("header", True).csv(path)
