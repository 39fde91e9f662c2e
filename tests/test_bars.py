"""Bars, late events, averages and signals against hand-made cases and the model."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from model import closed_points
from pyspark.sql import functions as F

from tickloom.operators import bars as b
from tickloom.operators import ema as m
from tickloom.operators import lateness as late
from tickloom.operators.registry import symbol_registry

TICKS = "symbol STRING, security_type STRING, price DOUBLE, event_ts TIMESTAMP, arrival BIGINT, partition INT"
START = datetime(2021, 11, 8, 8, tzinfo=timezone.utc)


def tick_frame(spark, rows):
    """rows: (symbol, partition, seconds from START, price), in arrival order."""
    data = [(s, "E", float(p), START + timedelta(seconds=sec), i, part) for i, (s, part, sec, p) in enumerate(rows)]
    return spark.createDataFrame(data, TICKS)


def as_model(rows):
    base = int(START.timestamp() * 1000)
    return [(s, part, base + round(sec * 1000), float(p)) for s, part, sec, p in rows]


def collected(points):
    result = {}
    for r in points.orderBy("symbol", "window_start").collect():
        start = int(r.window_start.replace(tzinfo=timezone.utc).timestamp() * 1000)
        result.setdefault(r.symbol, []).append((start, r.close, r.ema38, r.ema100, r.signal))
    return result


def random_rows(seed, n=1500, partitions=3, symbols=7, disorder=900.0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.randrange(symbols)
        sec = max(0.0, i * 20 + rnd.uniform(-disorder, disorder))
        rows.append((f"S{s}", s % partitions, round(sec, 3), round(rnd.uniform(1, 100), 2)))
    return rows


def test_the_newest_window_stays_open(spark):
    rows = [("KITE", 1, 610, 7.25), ("KITE", 1, 905, 7.5), ("KITE", 1, 1490, 6.0), ("KITE", 1, 1510, 6.5)]
    points = m.ema_points(b.closed_bars(tick_frame(spark, rows))).orderBy("window_start").collect()
    assert [(p.window_start.minute, p.close, p.signal) for p in points] == [(10, 7.25, "BUY"), (15, 7.5, None), (20, 6.0, None)]


def test_one_average_step_per_window(spark):
    rows = [("OWL", 0, t, p) for t, p in ((1, 3.0), (2, 9.0), (298, 64.0), (301, 8.0), (599, 16.0), (600, 1.0))]
    points = m.ema_points(b.closed_bars(tick_frame(spark, rows))).orderBy("window_start").collect()
    assert [p.close for p in points] == [64.0, 16.0]
    weight = 2.0 / 39
    assert points[0].ema38 == weight * 64.0
    assert points[1].ema38 == weight * 16.0 + (1 - weight) * (weight * 64.0)


def test_latest_event_wins_and_ties_go_to_the_later_arrival(spark):
    rows = [("A", 0, 10, 1.0), ("A", 0, 30, 2.0), ("A", 0, 20, 3.0), ("A", 0, 30, 4.0), ("A", 0, 5, 5.0)]
    assert b.bars(tick_frame(spark, rows)).collect()[0].close == 4.0
    by_struct = tick_frame(spark, rows).withColumn("arrival", F.struct(F.lit("f").alias("file"), F.col("arrival").alias("row")))
    assert b.bars(by_struct).collect()[0].close == 4.0


def test_closes_when_arrivals_outgrow_the_packed_bits(spark):
    rnd = random.Random(12)
    rows = [("A", 0, rnd.randrange(40) * 3600, float(n)) for n in range(400)]
    spread = tick_frame(spark, rows).withColumn("arrival", F.col("arrival") * 5_000_000_001)
    got = {r.window_start: r.close for r in b.bars(spread, "10 days").collect()}
    plain = spread.withColumn("arrival", F.struct(F.lit(0).alias("f"), F.col("arrival").alias("n")))
    assert got == {r.window_start: r.close for r in b.bars(plain, "10 days").collect()}
    best = max(enumerate(rows), key=lambda x: (x[1][2], x[0]))
    assert best[1][3] in got.values()


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block_rows", [1, 37, 1 << 20])
def test_closed_points_equal_the_model(spark, seed, block_rows):
    rows = random_rows(seed)
    got = collected(m.ema_points(b.closed_bars(tick_frame(spark, rows), rows=block_rows)))
    assert got == closed_points(as_model(rows))


def test_one_symbol_holding_most_ticks(spark):
    rows = random_rows(5, n=3000, symbols=1, partitions=1) + random_rows(6, n=300)
    got = collected(m.ema_points(b.closed_bars(tick_frame(spark, rows), rows=64)))
    assert got == closed_points(as_model(rows))


def test_averages_carry_over_nights(spark):
    night = 16 * 3600
    times = [i * (300 + (i % 4 == 3) * night) for i in range(12)]
    rows = [("LARK", 2, t, 30 - i) for i, t in enumerate(times)]
    points = m.ema_points(b.closed_bars(tick_frame(spark, rows))).orderBy("window_start").collect()
    order = sorted(range(12), key=lambda i: times[i])
    kept = [p for p in collected(m.ema_points(b.closed_bars(tick_frame(spark, rows))))["LARK"]]
    assert kept == closed_points(as_model(rows))["LARK"] and len(points) <= len(order) - 1
    for before, now in zip(points, points[1:]):
        assert now.ema38 == m.ema_step(before.ema38, now.close, 38)


def test_registry_keeps_the_first_arrival(spark):
    rows = [("JAY", 0, 41, 2), ("EMU", 0, 7, 2), ("JAY", 0, 3, 2), ("EMU", 0, 90, 2), ("JAY", 0, 2, 2), ("TIT", 0, 1, 2)]
    found = {r.symbol: (r.first_seen.second, r.security_type) for r in symbol_registry(tick_frame(spark, rows)).collect()}
    assert found == {"JAY": (41, "E"), "EMU": (7, "E"), "TIT": (1, "E")}


def staged_rows():
    """Series that turn once, twice or never, with noise inside each window, one stray and one late tick."""
    level = {
        "DIP": lambda w: 40.0 if w < 50 else 2.0 if w < 70 else 90.0,
        "PEAK": lambda w: 12.0 if w < 55 else 31.0 if w < 75 else 0.5,
        "CALM": lambda w: 8.0,
        "STRAY": lambda w: 5.0 + w % 2,
    }
    rows = []
    for w in range(90):
        for at, noise in ((12, 0.97), (100, 1.04), (285, 1.0)):
            rows += [(s, i % 3, w * 300 + at, round(f(w) * noise, 3)) for i, (s, f) in enumerate(level.items())]
        if w == 20:
            rows.append(("STRAY", 0, 20 * 300 + 50, 4321.0))  # after the window's last tick, but earlier than it
        if w == 33:
            rows.append(("STRAY", 0, 9 * 300 + 299, 1234.0))  # a window that closed long ago
    return rows + [(s, i % 3, 90 * 300 + 1, 1.0) for i, s in enumerate(level)]


def test_staged_series(spark):
    rows = staged_rows()
    got = collected(m.ema_points(b.closed_bars(tick_frame(spark, rows), rows=100)))
    assert got == closed_points(as_model(rows))
    signals = {s: [p[4] for p in points if p[4]] for s, points in got.items()}
    assert signals == {"DIP": ["BUY", "SELL", "BUY"], "PEAK": ["BUY", "SELL"], "CALM": ["BUY"], "STRAY": ["BUY"]}
    closes = [p[1] for p in got["STRAY"]]
    assert max(closes) == 6.0 and len(closes) == 90


def test_formula_and_signal_truth_table(spark):
    assert m.ema_step(6.0, 45.0, 38) == pytest.approx(8.0, abs=1e-12)
    cases = [(3, 2, 2, 2, "BUY"), (3, 2, 1, 2, "BUY"), (2, 3, 3, 3, "SELL"), (2, 3, 4, 3, "SELL"), (5, 2, 4, 3, None), (2, 2, 3, 1, None)]
    frame = spark.createDataFrame([tuple(map(float, c[:4])) for c in cases], "f double, s double, pf double, ps double")
    got = [r[0] for r in frame.select(m.signal(*[F.col(c) for c in ("f", "s", "pf", "ps")])).collect()]
    assert got == [c[4] for c in cases]


def test_long_flat_series_signals_once(spark):
    flat = spark.range(20000).select(
        F.lit("FLAT").alias("symbol"),
        F.timestamp_seconds(F.col("id") * 300).alias("window_start"),
        F.timestamp_seconds(F.col("id") * 300 + 300).alias("window_end"),
        F.lit(50.0).alias("close"),
    )
    assert m.advisories(m.ema_points(flat)).count() == 1


def test_block_form_of_the_average_agrees(spark):
    rows = random_rows(9, n=4000, disorder=0)
    frame = b.bars(tick_frame(spark, rows))
    exact = m.ema(frame, (100,), seed=3.0).select("symbol", "window_start", "ema100")
    other = m.ema_by_day(frame, 100, seed=3.0).select("symbol", "window_start", F.col("ema100").alias("again"))
    joined = exact.join(other, ["symbol", "window_start"], "full")
    assert joined.where("ema100 IS NULL OR again IS NULL OR abs(ema100 - again) > 1e-9").count() == 0


@pytest.mark.parametrize("period, size", [(1, "5 minutes"), (3, "1 second"), (38, "1 second"), (250, "5 minutes")])
def test_block_form_for_any_period_and_bar_size(spark, period, size):
    rows = random_rows(10, n=3000, symbols=2, disorder=0)
    frame = b.bars(tick_frame(spark, [(s, p, t % 90_000, c) for s, p, t, c in rows]), size)
    exact = m.ema(frame, (period,), seed=5.0).select("symbol", "window_start", F.col(f"ema{period}").alias("one"))
    other = m.ema_by_day(frame, period, seed=5.0).select("symbol", "window_start", F.col(f"ema{period}").alias("two"))
    joined = exact.join(other, ["symbol", "window_start"], "full")
    assert joined.where("one IS NULL OR two IS NULL OR abs(one - two) > 1e-7").count() == 0


def test_block_form_over_months_with_gaps(spark):
    """Bars of two years with empty months: what starts a month comes from the last one with bars."""
    rnd = random.Random(12)
    days = sorted(rnd.sample([d for d in range(730) if (START + timedelta(days=d)).month not in (2, 7)], 150))
    bars = [(s, START + timedelta(days=d, minutes=5 * n), rnd.uniform(1, 9)) for s in "AB" for d in days for n in range(rnd.randrange(1, 5))]
    frame = spark.createDataFrame(bars, "symbol string, window_start timestamp, close double")
    exact = m.ema(frame, (38,), seed=2.0).select("symbol", "window_start", F.col("ema38").alias("one"))
    other = m.ema_by_day(frame, 38, seed=2.0).select("symbol", "window_start", F.col("ema38").alias("two"))
    joined = exact.join(other, ["symbol", "window_start"], "full")
    assert joined.count() == len(bars)
    assert joined.where("one IS NULL OR two IS NULL OR abs(one - two) > 1e-9").count() == 0


def test_averages_over_batches_of_any_size(spark):
    """Symbols and gaps may fall on batch borders; the numbers equal the recurrence to the last bit."""
    rnd = random.Random(4)
    bars = [(s, START + timedelta(minutes=5 * n), rnd.uniform(1, 9), rnd.uniform(1, 9) if rnd.random() < 0.7 else None) for s in "ABC" for n in range(50)]
    frame = spark.createDataFrame(bars, "symbol string, window_start timestamp, c double, d double")
    want = {}
    for series, place in (("c", 2), ("d", 3)):
        for symbol in "ABC":
            value = 0.0
            for row in (r for r in bars if r[0] == symbol):
                before, value = value, value if row[place] is None else m.ema_step(value, row[place], 38)
                want[symbol, row[1], series] = (before, None if row[place] is None else value)
    for size in (1, 7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = m.ema(frame, closes={"_c": "c", "_d": "d"}).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        found = {(r.symbol, r.window_start.replace(tzinfo=timezone.utc), s): (r[f"before38_{s}"], r[f"ema38_{s}"]) for r in got for s in "cd"}
        assert found == want


def test_order_inside_a_window_does_not_matter(spark):
    rows = random_rows(11, n=400, disorder=0)
    shuffled = sorted(rows, key=lambda r: (int(r[2] // 300), random.Random(str(r)).random()))
    first = {tuple(r) for r in b.bars(tick_frame(spark, rows)).collect()}
    second = {tuple(r) for r in b.bars(tick_frame(spark, shuffled)).collect()}
    assert first == second


def test_counterfactual_two_ways(spark):
    rows = random_rows(21)
    ticks = tick_frame(spark, rows)
    marked = b.with_stream_time(ticks, rows=50)
    one_pass = late.compare_points(late.both_points(marked)).collect()[0].asDict()
    actual = m.ema_points(b.closed_bars(ticks))
    ideal = m.ema_points(b.closed_bars(ticks, late_free=True))
    joined = late.compare_points(late.pair_points(actual, ideal)).collect()[0].asDict()
    assert one_pass["missing_actual_points"] > 0 and one_pass["close_changes"] > 0
    for name, value in one_pass.items():
        assert joined[name] == pytest.approx(value, rel=1e-12), name
    kept = closed_points(as_model(rows))
    assert one_pass["actual_points"] == sum(map(len, kept.values()))
    whole = closed_points(as_model(rows), drop_late=False)
    assert one_pass["ideal_points"] == sum(map(len, whole.values()))


def test_lateness_of_an_empty_day(spark):
    marked = b.with_stream_time(tick_frame(spark, []))
    totals = late.late_totals(marked).collect()[0]
    assert (totals.events, totals.late, totals.late_rate) == (0, 0, 0.0)
    assert late.late_percentiles(marked).collect()[0].asDict() == {"p50": 0, "p95": 0, "p99": 0, "max": 0}
