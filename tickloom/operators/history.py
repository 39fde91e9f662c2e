"""Reading the point history: range lookups, day views, session breaks, latest values."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.times import epoch_millis
from tickloom.schemas import HISTORY_DAYS, HISTORY_LIMIT

# Fixed value: the largest timestamp a lookup bound may name (the end of year 9999).
MAX_MILLIS = 253402300799000


def history_lookup(
    points: DataFrame, symbol: str, start_ms: int = 0, end_ms: int | None = None, limit: int = HISTORY_LIMIT
) -> DataFrame:
    """A symbol's points with window start in ``[start_ms, end_ms]`` (both inclusive): the newest ``limit``, ascending."""
    if not symbol.strip():
        raise ValueError("missing required parameter: symbol")
    top = MAX_MILLIS if end_ms is None else min(end_ms, MAX_MILLIS)
    low, high = F.timestamp_millis(F.lit(start_ms)), F.timestamp_millis(F.lit(top))
    kept = (F.col("symbol") == symbol.strip()) & F.col("window_start").between(low, high)
    if "day" in points.columns:  # a stored history: only the folders of these days are listed
        kept = kept & F.col("day").between(F.to_date(low), F.to_date(high))
    found = points.where(kept)
    newest = found.orderBy(F.col("window_start").desc()).limit(limit if limit > 0 else HISTORY_LIMIT)
    return newest.orderBy("window_start")


def _day(zone: str | None) -> Column:
    start = F.col("window_start")
    return F.to_date(start if zone is None else F.from_utc_timestamp(start, zone))


def day_view(points: DataFrame, day: date, zone: str | None = None) -> DataFrame:
    """Points of one day (UTC unless a zone is given)."""
    kept = _day(zone) == F.lit(day)
    if "day" in points.columns:  # a stored history: its folders are UTC days
        margin = timedelta(days=0 if zone is None else 1)
        kept = kept & F.col("day").between(F.lit(day - margin), F.lit(day + margin))
    return points.where(kept)


def days(points: DataFrame, zone: str | None = None) -> DataFrame:
    return points.select(_day(zone).alias("day")).distinct().orderBy("day")


def session_breaks(points: DataFrame, zone: str | None = None) -> DataFrame:
    """Points that open a new day for their symbol, the first point excepted."""
    by_symbol = Window.partitionBy("symbol").orderBy("window_start")
    dated = points.withColumn("day", _day(zone))
    marked = dated.withColumn("previous_day", F.lag("day").over(by_symbol))
    return marked.where(F.col("day") != F.col("previous_day"))


def latest_points(points: DataFrame) -> DataFrame:
    """Per symbol: the newest averages and the number of advisories in view."""
    newest = [F.max_by(c, "window_start").alias(c) for c in ("ema38", "ema100")]
    return points.groupBy("symbol").agg(
        F.max("window_start").alias("window_start"), *newest, F.count("signal").alias("advisories")
    )


def point_table(points: DataFrame) -> DataFrame:
    """Display rows, newest window first, an absent signal as ''."""
    return points.select(
        "symbol", "window_start", "window_end", F.coalesce("signal", F.lit("")).alias("signal"), "close", "ema38", "ema100"
    ).orderBy(F.col("window_start").desc(), "symbol")


def point_records(points: DataFrame) -> DataFrame:
    """Topic records of window results: key = symbol, times as milliseconds, an absent signal as JSON null."""
    body = F.struct(
        "symbol",
        "signal",
        "ema38",
        "ema100",
        "close",
        epoch_millis(F.col("window_start")).cast("double").alias("windowStart"),
        epoch_millis(F.col("window_end")).cast("double").alias("windowEnd"),
    )
    return points.select(F.col("symbol").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def retained(points: DataFrame, days: int = HISTORY_DAYS, now: datetime | None = None) -> DataFrame:
    """Points younger than ``days``, counted back from the newest window (or from ``now``)."""
    newest = F.lit(now) if now is not None else points.agg(F.max("window_start")).scalar()
    return points.where(F.col("window_start") > newest - F.expr(f"INTERVAL {days} DAYS"))
