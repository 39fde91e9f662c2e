"""Late-event audit and the comparison with a run in which nothing was late.

Input frames come from :func:`tickloom.operators.bars.with_stream_time`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.bars import closed_only, final_stream_time, window_closes
from tickloom.operators.ema import ema, signal
from tickloom.operators.scan import quantiles
from tickloom.schemas import BAR_SIZE, EMA_PERIODS, MARKET_ZONE

# Grace periods the audit tries, and the size below which two averages are equal.
GRACE_MS = (1_000, 10_000, 60_000, 300_000, 900_000, 3_600_000)
SAME = 1e-12
LAG_FRACTIONS = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def lag_ms() -> Column:
    """How far the partition's clock was past the window's end."""
    return F.unix_millis("stream_time") - F.unix_millis("window_end")


def late_events(marked: DataFrame) -> DataFrame:
    return marked.where("late").withColumn("lag_ms", lag_ms())


def late_by_window(marked: DataFrame) -> DataFrame:
    return marked.groupBy("window_start").agg(
        F.count("*").alias("events"),
        F.count_if("late").alias("late"),
        F.count_distinct(F.when(F.col("late"), F.col("symbol"))).alias("late_symbols"),
    )


def late_totals(marked: DataFrame, rows_seen: DataFrame | None = None) -> DataFrame:
    """One row: events, late events and rate, windows and symbols touched.

    ``rows_seen`` is the raw frame whose rows were scanned, when it differs.
    """
    late = F.col("late")
    totals = marked.agg(
        F.count("*").alias("events"),
        F.count_if(late).alias("late"),
        F.coalesce(F.try_divide(F.count_if(late).cast("double"), F.count("*")), F.lit(0.0)).alias("late_rate"),
        F.count_distinct(F.when(late, F.col("window_start"))).alias("late_windows"),
        F.count_distinct(F.when(late, F.col("symbol"))).alias("late_symbols"),
    )
    seen = F.col("events") if rows_seen is None else rows_seen.agg(F.count("*")).scalar()
    return totals.withColumn("rows_seen", seen)


def late_percentiles(marked: DataFrame) -> DataFrame:
    """Nearest-rank lag percentiles and the maximum (0 when nothing is late), in one row."""
    lags = late_events(marked).select("lag_ms")
    placed = quantiles(lags, "lag_ms", {**LAG_FRACTIONS, "max": 1.0}, nearest=True)
    return placed.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in placed.columns])


def grace_recovery(marked: DataFrame, grace_ms=GRACE_MS) -> DataFrame:
    """Late events a grace period would have kept, one row per period."""
    counts = late_events(marked).agg(*[F.count_if(F.col("lag_ms") < g).alias(str(g)) for g in grace_ms])
    pairs = F.array(*[F.struct(F.lit(g).cast("bigint").alias("grace_ms"), F.col(str(g)).alias("recovered")) for g in grace_ms])
    return counts.select(F.inline(pairs))


def replay_span_ms(ticks: DataFrame) -> DataFrame:
    """Time from the first event to arrive to the latest one."""
    span = F.unix_millis(F.max("event_ts")) - F.unix_millis(F.min_by("event_ts", "arrival"))
    return ticks.agg(F.min_by("event_ts", "arrival").alias("first_event"), span.alias("span_ms"))


def late_by_hour(marked: DataFrame, zone: str = MARKET_ZONE) -> DataFrame:
    """Events, late events and rate by the local hour in which their window starts."""
    hour = F.hour(F.from_utc_timestamp("window_start", zone)).alias("hour")
    counts = marked.groupBy(hour).agg(F.count("*").alias("events"), F.count_if("late").alias("late"))
    return counts.withColumn("late_rate", F.col("late").cast("double") / F.col("events"))


def both_points(marked: DataFrame, periods=EMA_PERIODS, size: str = BAR_SIZE) -> DataFrame:
    """Closed points of the actual run (late ticks dropped) and of the ideal one, side by side.

    One aggregation yields both closes and one pass both sets of averages; a
    window whose ticks were all late has no actual close, which leaves the
    actual averages where they were. Suffixes: ``_actual`` and ``_ideal``.
    """
    closes = window_closes(marked, size, ["partition"], {"close_ideal": None, "close_actual": ~F.col("late")})
    closed = closed_only(closes, final_stream_time(marked)).drop("partition")
    series = {"_actual": "close_actual", "_ideal": "close_ideal"}
    averaged = ema(closed, periods, closes=series)
    fast, slow = periods
    for s, close in series.items():
        crossed = signal(*[F.col(f"{kind}{p}{s}") for kind in ("ema", "before") for p in (fast, slow)])
        averaged = averaged.withColumn(f"signal{s}", F.when(F.col(close).isNotNull(), crossed))
    return averaged.drop(*[f"before{p}{s}" for p in periods for s in series])


def pair_points(actual: DataFrame, ideal: DataFrame, periods=EMA_PERIODS) -> DataFrame:
    """The same side-by-side frame from two separately computed point frames (a full outer join)."""
    keys = ["symbol", "window_start"]
    columns = ["close", *[f"ema{p}" for p in periods], "signal"]

    def side(points: DataFrame, s: str) -> DataFrame:
        return points.select(*keys, *[F.col(c).alias(f"{c}{s}") for c in columns])

    return side(actual, "_actual").join(side(ideal, "_ideal"), keys, "full_outer")


def compare_points(pairs: DataFrame, periods=EMA_PERIODS) -> DataFrame:
    """One row: point counts, changed closes, averages and signals, missing points, average differences."""
    fast, slow = periods
    here, there = F.col("close_actual").isNotNull(), F.col("close_ideal").isNotNull()
    both = here & there
    gap = {p: F.when(both, F.abs(F.col(f"ema{p}_actual") - F.col(f"ema{p}_ideal"))) for p in periods}
    other_signal = ~F.col("signal_actual").eqNullSafe(F.col("signal_ideal"))
    lost_signal = ~here & F.col("signal_ideal").isNotNull()
    deltas = []
    for p in periods:
        deltas += [
            F.coalesce(F.avg(gap[p]), F.lit(0.0)).alias(f"mean_abs_ema{p}_delta"),
            F.coalesce(F.max(gap[p]), F.lit(0.0)).alias(f"max_abs_ema{p}_delta"),
        ]
    return pairs.agg(
        F.count_if(here).alias("actual_points"),
        F.count_if(there).alias("ideal_points"),
        F.count_if(both & (F.col("close_actual") != F.col("close_ideal"))).alias("close_changes"),
        F.count_if((gap[fast] > SAME) | (gap[slow] > SAME)).alias("ema_changes"),
        F.count_if((both & other_signal) | lost_signal).alias("signal_changes"),
        F.count_if(~here).alias("missing_actual_points"),
        *deltas,
    )
