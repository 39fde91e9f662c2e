"""The rollup ladder, its stored form and the reports."""

import random
import shutil
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tickloom.operators import profile as p
from tickloom.sources import tables

START = datetime(2021, 11, 8, 7, 30, tzinfo=timezone.utc)


def facts(spark, n=4000):
    rnd = random.Random(5)
    rows = []
    for _ in range(n):
        symbol = rnd.choice(["A.NL", "A.NL", "A.NL", "B.FR", "C", None])
        at = START + timedelta(seconds=rnd.randrange(5 * 86400))
        rows.append((symbol, rnd.choice("EI"), at, rnd.random() < 0.4, rnd.uniform(-1, 5)))
    return rows, spark.createDataFrame(rows, "symbol string, security_type string, second timestamp, is_price_event boolean, volume double")


def test_stored_ladder_gives_the_same_reports(spark, tmp_path):
    rows, frame = facts(spark)
    p.write_rollups(frame, str(tmp_path))
    rollups = p.read_rollups(spark, str(tmp_path))
    reports = p.summary(rollups)
    assert len(reports) == 16
    totals = reports["totals"].first()
    assert totals.events == len(rows)
    assert totals.price_events == sum(r[3] for r in rows)
    assert abs(totals.volume - sum(r[4] for r in rows if r[3] and r[4] > 0)) < 1e-6
    assert totals.symbols == 3
    assert reports["by_day"].agg(F.sum("events")).first()[0] == len(rows)
    venues = {(r.exchange, r.security_type) for r in reports["by_exchange"].collect()}
    assert {v for v, _ in venues} == {"NL", "FR", "C"}
    shares = reports["concentration"].where("events_share IS NOT NULL").orderBy("rank").collect()
    assert [r["rank"] for r in shares] == [1]
    p.write_summary(rollups, str(tmp_path))
    ranking = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_path}/price_events_by_symbol")
    last = ranking.orderBy(F.desc("price_rank")).first()
    assert last.price_rank == 3 and abs(last.cumulative_event_share - 1) < 1e-12
    assert spark.read.json(f"{tmp_path}/summary/totals").first().events == len(rows)


def test_minutes_count_distinct_symbols_only(spark):
    rows = [("A", START), ("A", START + timedelta(seconds=1)), ("B", START), (None, START)]
    frame = spark.createDataFrame(rows, "symbol string, second timestamp").withColumns(
        {"security_type": F.lit("E"), "is_price_event": F.lit(True), "volume": F.lit(0.0)}
    )
    sec = p.symbol_seconds(frame)
    minute = p.minute_totals(sec).first()
    assert (minute.events, minute.active_symbols, minute.volume) == (4, 2, 0.0)
    assert p.symbol_minute(sec).count() == 2


def test_peak_minute_takes_the_earliest_of_equals(spark):
    rows = [("A", "E", START + timedelta(minutes=n), v, 1, 0.0) for n, v in ((3, 5), (1, 5), (2, 4))]
    frame = spark.createDataFrame(rows, "symbol string, security_type string, ts timestamp, events long, price_events long, volume double")
    got = p.symbol_totals(frame).first()
    assert got.peak_minute == (START + timedelta(minutes=1)).replace(tzinfo=None)
    assert got.peak_price_minute == got.peak_minute and got.peak_minute_events == 5


def test_dense_grid(spark):
    rows = [("A", START, 1), ("A", START + timedelta(minutes=14), 2), ("A", START + timedelta(minutes=45), 4), ("A", START + timedelta(hours=9), 8)]
    series = spark.createDataFrame(rows, "symbol string, t timestamp, n long")
    grid = p.dense(series, ["symbol"], F.lit(START), "15 minutes", 4).orderBy("i").collect()
    assert [r.n for r in grid] == [3, 0, 0, 4]
    assert [r.i for r in grid] == [0, 1, 2, 3]


def test_bins(spark):
    counts = [1, 9, 10, 99, 100, 1000, 0]
    frame = spark.createDataFrame([(f"S{n}", c) for n, c in enumerate(counts)], "symbol string, price_events long")
    bins = {r.event_range: r.symbols for r in p.symbol_bins(frame).collect()}
    assert bins == {"1-9": 2, "10-99": 2, "100-999": 1, "1000-9999": 1}


def test_distinct_symbols_of_any_span(spark):
    rnd = random.Random(11)
    rows = [(f"S{rnd.randrange(70_000)}", START + timedelta(days=rnd.randrange(6), minutes=rnd.randrange(600))) for _ in range(30_000)]
    sym_min = spark.createDataFrame(rows, "symbol string, ts timestamp")
    numbers = p.symbol_numbers(sym_min)
    assert sorted(r.number for r in numbers.collect()) == list(range(len({s for s, _ in rows})))
    bitmaps = p.day_bitmaps(sym_min, numbers)
    first = START.date()
    spans = [(first + timedelta(days=a), first + timedelta(days=a + n)) for a in range(6) for n in (0, 3, 30)]
    got = {(r.first, r.last): r.symbols for r in p.distinct_in_spans(bitmaps, spark.createDataFrame(spans, "first date, last date")).collect()}
    assert got == {(a, b): len({s for s, t in rows if a <= t.date() <= b}) for a, b in spans}


def test_only_days_that_changed_are_collapsed_again(spark, tmp_path):
    rnd = random.Random(12)
    rows = [(rnd.choice("AB"), "E", START + timedelta(seconds=rnd.randrange(4 * 86400)), float(n)) for n in range(3000)]
    frame = spark.createDataFrame(rows, "symbol string, security_type string, event_ts timestamp, price double")
    ticks, out = str(tmp_path / "ticks"), str(tmp_path / "out")
    days = sorted({t.date() for _, _, t, _ in rows})
    of_day = F.to_date("event_ts") == F.lit(days[2])
    refresh = lambda: p.refresh_seconds(spark, ticks, out, p.facts_of_ticks)
    tables.store_ticks(frame.where(~of_day | (F.col("price") < 700)), ticks)
    assert refresh() == days and refresh() == []
    tables.store_ticks(frame.where(of_day), ticks)
    assert refresh() == [days[2]] and refresh() == []
    order = ["symbol", "second"]
    names = ["symbol", "security_type", "second", "events", "price_events", "volume"]
    kept = p.refreshed_seconds(spark, out).select(names).orderBy(order).collect()
    assert kept == p.symbol_seconds(p.facts_of_ticks(frame)).select(names).orderBy(order).collect()
    shutil.rmtree(tmp_path / f"ticks/day={days[0]}")
    assert refresh() == [] and p.refreshed_seconds(spark, out).agg(F.min("second")).first()[0].date() == days[1]
