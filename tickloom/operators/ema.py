"""Exponential moving averages and crossover signals over bars."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.scan import affine_starts
from tickloom.schemas import EMA_PERIODS


# The smallest weight inside a block of ``ema_by_day``.
LIGHTEST = 1e-9


def alpha(period: int) -> float:
    return 2.0 / (period + 1.0)


def ema_step(previous: float, close: float, period: int) -> float:
    """One step of the recurrence; the order of the operations fixes the rounding."""
    return alpha(period) * close + (1.0 - alpha(period)) * previous


def signal(fast: Column, slow: Column, previous_fast: Column, previous_slow: Column) -> Column:
    """BUY when the fast average crosses above the slow one, SELL when it crosses below, else NULL."""
    return F.when((fast > slow) & (previous_fast <= previous_slow), F.lit("BUY")).when(
        (fast < slow) & (previous_fast >= previous_slow), F.lit("SELL")
    )


def averages(closes: np.ndarray, period: int, start: float) -> np.ndarray:
    """The average before the first close and after each one, with the rounding of ``ema_step``."""
    keep = 1.0 - alpha(period)
    return np.fromiter(accumulate((alpha(period) * closes).tolist(), lambda value, part: part + keep * value, initial=start), float)


class _Walk:
    """Averages of all series and periods over batches of bars in order of symbol and time.

    Between batches it keeps the last symbol and one number per average.
    """

    def __init__(self, series: list[str], periods, seed: float, starts: dict[int, str] | None):
        self.series, self.periods, self.seed, self.starts = series, periods, seed, starts
        self.symbol: object = self  # no symbol yet
        self.state: dict = {}

    def columns(self, batch: pa.RecordBatch) -> list[pa.Array]:
        symbols = batch.column("symbol")
        codes = symbols.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
        closes = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in self.series}
        out = {(c, p): (np.empty(len(codes)), np.empty(len(codes))) for c in self.series for p in self.periods}
        for a, b in zip(edges, edges[1:]):
            symbol = symbols[a].as_py() if b > a else self.symbol
            if symbol != self.symbol:
                firsts = {p: batch.column(self.starts[p])[a].as_py() if self.starts else self.seed for p in self.periods}
                self.symbol, self.state = symbol, {k: firsts[k[1]] for k in out}
            for column in self.series:
                own = closes[column][a:b]
                there = ~np.isnan(own)  # no bar in this series: the average stands still
                place = np.cumsum(there)
                for p in self.periods:
                    found = averages(own[there], p, self.state[column, p])
                    after, before = out[column, p]
                    before[a:b] = found[place - there]
                    after[a:b] = np.where(there, found[place], np.nan)
                    self.state[column, p] = float(found[-1])
        return [pa.array(x, pa.float64(), from_pandas=True) for c in self.series for p in self.periods for x in out[c, p]]


def ema(
    bars: DataFrame,
    periods=EMA_PERIODS,
    seed: float = 0.0,
    closes: dict[str, str] | None = None,
    starts: dict[int, str] | None = None,
) -> DataFrame:
    """Add ``ema<p>`` and ``before<p>`` (the average before the bar) for every period.

    The recurrence is taken bar by bar, because signals need its exact
    rounding. Bars are shuffled by symbol, sorted, and streamed through Arrow
    batches with one number of state per average: a task never holds a symbol's
    bars together. A symbol has at most 288 bars a day however many ticks it
    had, so the input is small next to the ticks.

    ``closes`` maps a column suffix to a close column when several series share
    the bars; a NULL close is a window that series does not have. ``starts``
    names, per period, a column with the average each symbol begins with, when
    that is not ``seed``.
    """
    series = {"": "close"} if closes is None else closes
    names = [f"{kind}{p}{suffix}" for suffix in series for p in periods for kind in ("ema", "before")]
    schema = T.StructType(bars.schema.fields + [T.StructField(n, T.DoubleType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(list(series.values()), periods, seed, starts)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *walk.columns(batch)], names=[*batch.schema.names, *names])

    ordered = bars.repartition("symbol").sortWithinPartitions("symbol", "window_start")
    return ordered.mapInArrow(run, schema)


def ema_points(bars: DataFrame, periods=EMA_PERIODS, seed: float = 0.0, starts: dict[int, str] | None = None) -> DataFrame:
    """History points: bars with both averages and the crossover signal."""
    fast, slow = periods
    crossed = signal(*[F.col(f"{kind}{p}") for kind in ("ema", "before") for p in (fast, slow)])
    averaged = ema(bars, periods, seed, starts=starts).withColumn("signal", crossed)
    return averaged.drop(f"before{fast}", f"before{slow}", *(starts or {}).values())


def signals_by_lag(points: DataFrame, periods=EMA_PERIODS, seed: float = 0.0) -> DataFrame:
    """Signals for points whose averages are already stored, from the previous point of each symbol."""
    fast, slow = (F.col(f"ema{p}") for p in periods)
    by_symbol = Window.partitionBy("symbol").orderBy("window_start")
    before = [F.lag(c, 1, seed).over(by_symbol) for c in (fast, slow)]
    return points.withColumn("signal", signal(fast, slow, *before))


def advisories(points: DataFrame) -> DataFrame:
    """Only the points on which a signal fired."""
    return points.where(F.col("signal").isNotNull())


def ema_by_day(bars: DataFrame, period: int, seed: float = 0.0) -> DataFrame:
    """EMA values without a sequential pass: parallel inside a symbol, JVM-side only.

    Within a block of a day's bars the average is a weighted sum; a block ends
    before its first bar's weight falls below LIGHTEST, so no sum is divided by a
    vanishing one. A block maps the average before it to the one after it, and
    these maps are composed by day and by month, so no row holds more than the
    blocks of a symbol's month. Rounds differently from ``ema`` in the last
    digits, so use it for values, not for signals.
    """
    a, keep = alpha(period), 1.0 - alpha(period)
    if keep <= 0:
        return bars.withColumn(f"ema{period}", F.col("close").cast("double"))
    size = max(1, int(math.log(LIGHTEST) / math.log(keep)))
    dated = bars.withColumn("day", F.to_date("window_start"))
    in_day = Window.partitionBy("symbol", "day").orderBy("window_start")
    numbered = dated.withColumn("n", F.row_number().over(in_day) - 1)
    place = numbered.withColumns(
        {"month": F.trunc("day", "month"), "part": F.expr(f"n div {size}"), "i": F.pmod("n", F.lit(size)) + 1}
    )
    keys, levels = ["symbol"], ["month", "day", "part"]
    weight = F.pow(F.lit(keep), F.col("i"))
    upto = Window.partitionBy(*keys, *levels).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = place.withColumn("own", F.sum(F.lit(a) * F.col("close") / weight).over(upto) * weight)
    blocks = local.groupBy(*keys, *levels).agg(F.pow(F.lit(keep), F.max("i")).alias("weight"), F.max_by("own", "i").alias("own"))
    carries = affine_starts(blocks, keys, levels, seed)
    value = weight * F.col("start") + F.col("own")
    return local.join(carries, [*keys, *levels]).select(*bars.columns, value.alias(f"ema{period}"))
