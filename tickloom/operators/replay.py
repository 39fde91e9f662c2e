"""File- and order-aware operators: replay order, range cuts, window crossings, schedules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.text import blank_to_null
from tickloom.functions.times import wall_clock
from tickloom.operators.scan import arrival_block, first_run, nth_of_first_run, running, runs
from tickloom.schemas import BAR_SIZE, MARKET_ZONE

# Margins and run lengths that confirm a replay cut.
START_MARGIN = "5 minutes"
END_MARGIN = "60 seconds"
CONFIRM_ROWS = 1000


def file_starts(events: DataFrame) -> DataFrame:
    """First valid event time of each file by row order; files without one do not appear.

    Needs ``source_file``, ``block_start``, ``row_id``. The result has one row
    per file; write it once and pass it on to avoid a second pass over the files.
    """
    position = F.struct("block_start", "row_id")
    return events.groupBy("source_file").agg(F.min_by("event_ts", position).alias("file_start"))


def with_arrival(events: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Add ``arrival``: files by first event time (then path), then row order inside the file.

    Where rows have a ``source_rank``, files of a smaller rank come first. The
    struct compares field by field, so no global sort or row number is made. There
    is a row per file in ``starts``; stored and passed in, its measured size lets
    Spark join it without moving the events.
    """
    starts = file_starts(events) if starts is None else starts
    rank = ["source_rank"] if "source_rank" in events.columns else []
    arrival = F.struct(*rank, "file_start", "source_file", "block_start", "row_id").alias("arrival")
    joined = events.join(starts, "source_file")
    return joined.select(*[c for c in events.columns], arrival)


def in_range(ts: Column, start: datetime | None = None, end: datetime | None = None) -> Column:
    """Half-open ``[start, end)``; a missing bound is open; an empty interval is an error."""
    check_range(start, end)
    lower = ts >= F.lit(start) if start is not None else F.lit(True)
    upper = ts < F.lit(end) if end is not None else F.lit(True)
    return lower & upper


def check_range(start: datetime | None, end: datetime | None) -> None:
    if start is not None and end is not None and not start < end:
        raise ValueError("the range start must lie before its end")


def replay_range(events: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    return events.where(in_range(F.col("event_ts"), start, end))


def select_files(starts: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Files that can hold events in the range: a file ends where the next one starts.

    Works on the one-row-per-file table; read only the returned paths.
    """
    check_range(start, end)
    following = F.lead("file_start").over(Window.orderBy("file_start", "source_file"))
    begins = F.col("file_start") < F.lit(end) if end is not None else F.lit(True)
    ends = F.coalesce(F.col("next_start") > F.lit(start), F.lit(True)) if start is not None else F.lit(True)
    return starts.withColumn("next_start", following).where(begins & ends)


def system_time_key(date: Column, time: Column) -> Column:
    """Sortable ``yyyyMMddHH:mm:ss.SSS`` text from the system date and time, NULL when either is absent."""
    d, t = F.trim(date), blank_to_null(time)
    parts = F.concat(F.substring(d, 7, 4), F.substring(d, 4, 2), F.substring(d, 1, 2), t)
    return F.when((F.length(d) == 10) & t.isNotNull(), parts)


def _file_runs(rows: DataFrame, flag: Column) -> DataFrame:
    position = F.struct("block_start", "row_id")
    return runs(rows, flag=flag, order=position, block=F.col("block_start"), keys=["source_file"])


def seek_start(raw: DataFrame, start: datetime, confirm_rows: int = CONFIRM_ROWS, zone: str = MARKET_ZONE) -> DataFrame:
    """Drop each file's rows before its first run of ``confirm_rows`` rows near the range start.

    A row is near when its system time is at most five minutes before ``start``;
    rows without a system time neither extend nor break a run; a run still open
    at the end of the file counts. An opt-in cleaning step: ``replay_range``
    alone is exact on event time. ``start`` is an instant.
    """
    bound = wall_clock(F.lit(start) - F.expr(f"INTERVAL {START_MARGIN}"), "yyyyMMddHH:mm:ss.SSS", zone)
    near = system_time_key(F.col("date"), F.col("time")) >= bound
    begins = first_run(_file_runs(raw, near), confirm_rows, ["source_file"], accept_open=True)
    kept = F.struct("block_start", "row_id") >= F.col("run_start")
    return raw.join(begins.select("source_file", "run_start"), "source_file").where(kept).select(*raw.columns)


def stop_after_end(events: DataFrame, end: datetime, confirm_rows: int = CONFIRM_ROWS) -> DataFrame:
    """Cut each file after ``confirm_rows`` consecutive events at least 60 s past ``end``.

    Isolated future timestamps cut nothing.
    """
    past = F.col("event_ts") >= F.lit(end) + F.expr(f"INTERVAL {END_MARGIN}")
    cuts = nth_of_first_run(_file_runs(events, past), confirm_rows, ["source_file"])
    position = F.struct("block_start", "row_id")
    kept = F.col("confirmed_at").isNull() | (position <= F.col("confirmed_at"))
    return events.join(cuts, "source_file", "left").where(kept).select(*events.columns)


def replay_schedule(events: DataFrame, speed: float) -> DataFrame:
    """Add ``offset_ns``: when to send an event, relative to the first one, at ``speed`` (0 = at once)."""
    if not (0 <= speed < float("inf")):
        raise ValueError("speed must be a finite non-negative multiplier")
    if speed == 0:
        return events.withColumn("offset_ns", F.lit(0).cast("bigint"))
    first = events.agg(F.min_by(F.unix_millis("event_ts"), "arrival").alias("ms")).scalar()
    gap = F.unix_millis("event_ts") - first
    scaled = F.least(gap.cast("double") * F.lit(1e6) / F.lit(float(speed)), F.lit(9.2233720368547e18))
    return events.withColumn("offset_ns", F.when(gap <= 0, F.lit(0)).otherwise(F.floor(scaled)).cast("bigint"))


def window_crossings(events: DataFrame, size: str = BAR_SIZE) -> DataFrame:
    """First event, in arrival order, of each newly reached window, with the window it closes.

    ``closes`` is NULL for the first row; events of older windows give nothing; a
    jump over several windows reports one close.
    """
    opened = events.select("arrival", "symbol", "event_ts", F.window("event_ts", size).start.alias("window_start"))
    scanned = running(
        opened,
        order="arrival",
        block=arrival_block(opened),
        values={"closes": ("window_start", "max")},
    )
    return scanned.where(F.col("closes").isNull() | (F.col("window_start") > F.col("closes")))
