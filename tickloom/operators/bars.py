"""Stream time, late events and tumbling last-price bars."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.scan import BLOCK_ROWS, arrival_block, running
from tickloom.schemas import BAR_SIZE


def _joint(first: Column, second: Column) -> Column:
    """Two BIGINTs, the second not negative, as one fixed-width ordering."""
    shift = F.expr("10000000000000000000BD")  # 19 digits hold any BIGINT
    return first.cast("decimal(18,0)") * shift + second.cast("decimal(19,0)")


def recency(ticks: DataFrame) -> Column:
    """Ordering of ticks in a single aggregation: event time, then arrival.

    An integer arrival gives a fixed-width decimal, which keeps the aggregation
    hash-based; a struct (file arrival) is compared field by field.
    """
    if isinstance(ticks.schema["arrival"].dataType, T.IntegralType):
        return _joint(F.unix_micros("event_ts"), F.col("arrival"))
    return F.struct("event_ts", "arrival")


def with_stream_time(ticks: DataFrame, size: str = BAR_SIZE, grace: str | None = None, rows: int = BLOCK_ROWS) -> DataFrame:
    """Add window bounds, ``stream_time`` (latest event time seen earlier in the partition) and ``late``.

    A tick is late when its window's end (plus ``grace``) is not after the
    stream time. Exact in arrival order, for any number of partitions: the scan
    is cut into arrival blocks.
    """
    window = F.window("event_ts", size)
    opened = ticks.withColumns({"window_start": window.start, "window_end": window.end})
    scanned = running(
        opened,
        keys=["partition"],
        order="arrival",
        block=arrival_block(ticks, rows=rows),
        values={"stream_time": ("event_ts", "max")},
    )
    closes = F.col("window_end") if grace is None else F.col("window_end") + F.expr(f"INTERVAL {grace}")
    return scanned.withColumn("late", F.coalesce(closes <= F.col("stream_time"), F.lit(False)))


def drop_late(ticks: DataFrame, size: str = BAR_SIZE, grace: str | None = None, rows: int = BLOCK_ROWS) -> DataFrame:
    return with_stream_time(ticks, size, grace, rows).where(~F.col("late")).select(*ticks.columns)


def window_closes(
    ticks: DataFrame, size: str = BAR_SIZE, extra_keys: list[str] = [], when: dict[str, Column | None] = {"close": None}
) -> DataFrame:
    """Per symbol and non-empty window, the price of its latest event; ties go to the later arrival.

    ``when`` maps a close column to the ticks it may use (None = all); a close
    without ticks is NULL.

    An integer arrival is packed with the event's offset into its window into
    one BIGINT, so the ticks are hash-aggregated on fixed-width state. The
    arrival's high bits, which do not fit, become a second key; only windows
    whose arrivals straddle such a span (2^34 arrivals for five minutes) have
    more than one row to merge. A struct arrival makes Spark sort each task's
    rows first.
    """
    keys = ["symbol", *extra_keys, "w"]
    rows = ticks.withColumn("w", F.window("event_ts", size))

    def only(value: Column, condition: Column | None) -> Column:
        return value if condition is None else F.when(condition, value)

    if isinstance(ticks.schema["arrival"].dataType, T.IntegralType):
        low = 63 - (pd.Timedelta(size).value // 1000).bit_length()
        mask = F.lit((1 << low) - 1)
        arrival = F.col("arrival").cast("bigint")
        offset = F.unix_micros("event_ts") - F.unix_micros(F.col("w.start"))
        packed = F.shiftleft(offset, low).bitwiseOR(arrival.bitwiseAND(mask))
        latest = []
        for name, condition in when.items():
            at = only(packed, condition)
            latest += [F.max_by(only(F.col("price"), condition), at).alias(name), F.max(at).alias(f"{name}_at")]
        spans = rows.groupBy(*keys, F.shiftright(arrival, low).alias("span")).agg(*latest)

        def place(name: str) -> Column:
            at = F.col(f"{name}_at")
            whole = F.shiftleft(F.col("span"), low).bitwiseOR(at.bitwiseAND(mask))
            return _joint(F.shiftright(at, low), whole)

        closes = spans.groupBy(*keys).agg(*[F.max_by(name, place(name)).alias(name) for name in when])
    else:
        order = F.struct("event_ts", "arrival")
        closes = rows.groupBy(*keys).agg(
            *[F.max_by(only(F.col("price"), c), only(order, c)).alias(name) for name, c in when.items()]
        )
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return closes.select("symbol", *extra_keys, *bounds, *when)


def bars(ticks: DataFrame, size: str = BAR_SIZE, extra_keys: list[str] = []) -> DataFrame:
    """One row per symbol and non-empty window with its ``close``."""
    return window_closes(ticks, size, extra_keys)


def final_stream_time(ticks: DataFrame) -> DataFrame:
    """Latest event time per partition."""
    return ticks.groupBy("partition").agg(F.max("event_ts").alias("final_time"))


def closed_only(keyed_bars: DataFrame, final_time: DataFrame) -> DataFrame:
    """Bars (with ``partition``) whose window the partition's clock has passed."""
    closed = keyed_bars.join(final_time, "partition").where(F.col("window_end") <= F.col("final_time"))
    return closed.drop("final_time")


def closed_bars(ticks: DataFrame, size: str = BAR_SIZE, late_free: bool = False, rows: int = BLOCK_ROWS) -> DataFrame:
    """The bars the stream would emit: late ticks dropped, open windows withheld.

    ``late_free`` skips the arrival scan for input already known to be in order.
    """
    kept = ticks if late_free else drop_late(ticks, size, rows=rows)
    return closed_only(bars(kept, size, ["partition"]), final_stream_time(ticks)).drop("partition")


def bar_records(frame: DataFrame) -> DataFrame:
    """Bars as topic records: key = symbol, value = JSON with close and window bounds in milliseconds."""
    body = F.struct(
        "symbol",
        F.col("close").alias("lastClose"),
        F.unix_millis("window_start").cast("double").alias("windowStart"),
        F.unix_millis("window_end").cast("double").alias("windowEnd"),
    )
    return frame.select(F.col("symbol").alias("key"), F.to_json(body).alias("value"))
