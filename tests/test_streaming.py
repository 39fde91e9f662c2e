"""Streaming forms against the batch operators and the model."""

import json
import os
import time
from datetime import timedelta

import pytest
from model import closed_points
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_bars import START, TICKS, as_model, collected, staged_rows, random_rows, tick_frame

from tickloom.operators import bars as b
from tickloom.operators import ema as m
from tickloom.operators.ingest import ACCEPTED
from tickloom.sources.files import follow_ndjson
from tickloom.streaming import crossover, exact
from tickloom.streaming.metrics import ProgressLog


def write_parts(spark, rows, folder, parts):
    """Rows as files that a stream reads one after the other."""
    frame = tick_frame(spark, rows)
    size = -(-len(rows) // parts)
    os.makedirs(folder)
    for n in range(parts):
        frame.where(F.col("arrival").between(n * size, (n + 1) * size - 1)).coalesce(1).write.parquet(f"{folder}-{n}")
        (name,) = [f for f in os.listdir(f"{folder}-{n}") if f.endswith(".parquet")]
        os.rename(f"{folder}-{n}/{name}", f"{folder}/{n}.parquet")
        os.utime(f"{folder}/{n}.parquet", (1_600_000_000 + n * 10, 1_600_000_000 + n * 10))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream(spark, folder, files=1):
    return spark.readStream.schema(TICKS).option("maxFilesPerTrigger", files).parquet(folder)


def history(spark, out):
    return spark.read.parquet(f"{out}/history")


def test_one_file_per_batch_equals_batch_when_nothing_is_late(spark, tmp_path):
    rows = [r for r in random_rows(31, n=240, partitions=1, disorder=0)]
    write_parts(spark, rows, f"{tmp_path}/in", 3)
    out = f"{tmp_path}/out"
    run(crossover.write_points(crossover.stream_points(stream(spark, f"{tmp_path}/in")), out, f"{tmp_path}/c"))
    assert collected(history(spark, out)) == collected(m.ema_points(b.closed_bars(tick_frame(spark, rows))))
    signals = spark.read.parquet(f"{out}/advisories")
    assert signals.where("signal IS NULL").count() == 0
    assert signals.count() == history(spark, out).where("signal IS NOT NULL").count() > 0


def test_watermark_moves_between_batches_only(spark, tmp_path):
    """A late tick of the same file is counted by the watermark form and dropped by the exact one."""
    rows = [("A", 0, 10, 1.0), ("A", 0, 430, 2.0), ("A", 0, 70, 3.0), ("A", 0, 700, 4.0), ("A", 0, 80, 9.0)]
    write_parts(spark, rows[:4], f"{tmp_path}/in", 1)
    out = f"{tmp_path}/out"
    log = ProgressLog(spark, f"{tmp_path}/progress", every=2)
    spark.streams.addListener(log)
    try:
        points = lambda: crossover.write_points(crossover.stream_points(stream(spark, f"{tmp_path}/in")), out, f"{tmp_path}/c")
        run(points())
        write_parts(spark, rows, f"{tmp_path}/all", 5)
        os.rename(f"{tmp_path}/all/4.parquet", f"{tmp_path}/in/9.parquet")
        run(points())
        time.sleep(2)
    finally:
        spark.streams.removeListener(log)
    closes = [r.close for r in history(spark, out).orderBy("window_start").collect()]
    assert closes == [3.0, 2.0]
    frame = log.frame()
    assert frame.agg(F.sum("late_rows")).first()[0] == 1
    assert frame.agg(F.sum("input_rows")).first()[0] == 5
    assert [p[1] for p in closed_points(as_model(rows))["A"]] == [1.0, 2.0]


@pytest.mark.parametrize("parts", [1, 4])
def test_exact_form_equals_the_model(spark, tmp_path, parts):
    rows = random_rows(41, n=300)
    write_parts(spark, rows, f"{tmp_path}/in", parts)
    out = f"{tmp_path}/out"
    run(exact.write_exact_points(stream(spark, f"{tmp_path}/in"), out, f"{tmp_path}/c"))
    assert collected(history(spark, out)) == closed_points(as_model(rows))


def test_exact_form_on_the_staged_series(spark, tmp_path):
    rows = staged_rows()
    write_parts(spark, rows, f"{tmp_path}/in", 2)
    run(exact.write_exact_points(stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/c"))
    assert collected(history(spark, f"{tmp_path}/out")) == closed_points(as_model(rows))


def test_exact_batch_may_run_twice(spark, tmp_path):
    rows = random_rows(43, n=200)
    frame = tick_frame(spark, rows).cache()
    for batch, (low, high) in ((0, (0, 99)), (1, (100, 199)), (1, (100, 199))):
        exact.process(frame.where(F.col("arrival").between(low, high)), batch, str(tmp_path))
    assert collected(history(spark, tmp_path)) == closed_points(as_model(rows))


def test_exact_state_stays_small_and_must_be_there(spark, tmp_path):
    """Two versions of the state are kept; a batch does not start empty because its predecessor's state is gone."""
    rows = random_rows(47, n=120)
    frame = tick_frame(spark, rows).cache()
    for batch in range(6):
        exact.process(frame.where(F.col("arrival").between(batch * 20, batch * 20 + 19)), batch, str(tmp_path))
        assert sorted(int(n) for n in os.listdir(tmp_path / "state")) == [n for n in (batch - 1, batch) if n >= 0]
    assert collected(history(spark, tmp_path)) == closed_points(as_model(rows))
    with pytest.raises(AnalysisException):
        exact.process(frame, 9, str(tmp_path))


def test_every_progress_row_is_kept(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "progress"), every=5000)
    for n in range(12_000):
        log.add(("q", n, "2023-01-16T09:00:00.000Z", 2, 1.0, 1.0, n % 2, 0, None, 1, None, None))
        assert len(log.waiting) < 5000
    assert log.frame().agg(F.count("*"), F.count_distinct("batch_id"), F.sum("late_rows")).first()[:] == (12_000, 12_000, 6_000)


def test_registry_stream(spark, tmp_path):
    rows = [(s, 0, t, 1.0) for t, s in enumerate(["AAA", "BBB", "AAA", "CCC", "BBB", "AAA"])]
    write_parts(spark, rows, f"{tmp_path}/in", 3)
    run(crossover.write_registry(stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/c"))
    found = spark.read.parquet(f"{tmp_path}/out/symbols").orderBy("symbol").collect()
    assert [(r.symbol, r.first_seen.second, r.batch_id) for r in found] == [("AAA", 0, 0), ("BBB", 1, 0), ("CCC", 3, 1)]


def test_registry_reads_nothing_but_new_ticks(spark, tmp_path, monkeypatch):
    """Many micro-batches, a restart, and symbols known from before; no batch reads the registry table."""
    names = ["A", "B", "A", "OLD", "C", "A", "B", "D", "A", "C", "A", "E"]
    rows = [(s, 0, t, 1.0) for t, s in enumerate(names)]
    write_parts(spark, rows, f"{tmp_path}/in", 12)
    known = spark.createDataFrame([("OLD", "E")], "symbol string, security_type string")
    monkeypatch.setattr("tickloom.sources.tables.read_table", None)
    ticks = stream(spark, f"{tmp_path}/in")
    log = ProgressLog(spark, str(tmp_path / "progress"), every=1000)
    spark.streams.addListener(log)
    try:
        run(crossover.write_registry(ticks, f"{tmp_path}/out", f"{tmp_path}/c", known))
        log.ended.wait(60)
    finally:
        spark.streams.removeListener(log)
    read = [r.input_rows for r in log.frame().orderBy("batch_id").collect()]
    assert len(read) == 12 and set(read) == {1}  # one tick is all that a micro-batch reads
    late = [("F", 0, 50, 1.0), ("A", 0, 51, 1.0)]
    write_parts(spark, rows + late, f"{tmp_path}/more", 14)
    for n in (12, 13):
        os.rename(f"{tmp_path}/more/{n}.parquet", f"{tmp_path}/in/{n}.parquet")
    run(crossover.write_registry(ticks, f"{tmp_path}/out", f"{tmp_path}/c", known))
    found = spark.read.parquet(f"{tmp_path}/out/symbols").collect()
    assert sorted((r.symbol, r.first_seen.second) for r in found) == [("A", 0), ("B", 1), ("C", 4), ("D", 7), ("E", 11), ("F", 50)]


def test_registry_takes_the_first_arrival_of_a_batch(spark, tmp_path):
    rows = [("A", 0, 9, 1.0), ("B", 0, 3, 1.0), ("A", 0, 2, 1.0), ("B", 0, 8, 1.0)]
    write_parts(spark, rows, f"{tmp_path}/in", 1)
    nested = stream(spark, f"{tmp_path}/in").withColumn("arrival", F.struct(F.lit("f").alias("file"), F.col("arrival").alias("n")))
    run(crossover.write_registry(nested, f"{tmp_path}/out", f"{tmp_path}/c"))
    found = spark.read.parquet(f"{tmp_path}/out/symbols").collect()
    assert sorted((r.symbol, r.first_seen.second) for r in found) == [("A", 9), ("B", 3)]


def test_a_backfill_waits_in_state_by_day(spark, tmp_path):
    """Far more bars of a symbol in one micro-batch than are sorted in memory."""
    rows = [(s, 0, n * 300 + 7, 50.0 + (n * 7919) % 101 + k) for n in range(2500) for k, s in enumerate("AB")]
    write_parts(spark, rows, f"{tmp_path}/in", 1)
    bars = crossover.stream_bars(stream(spark, f"{tmp_path}/in"))
    points = bars.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=crossover.CrossoverProcessor(limit=100), outputStructType=crossover.POINT, outputMode="Append", timeMode="None"
    )
    run(crossover.write_points(points, f"{tmp_path}/out", f"{tmp_path}/c"))
    assert collected(history(spark, f"{tmp_path}/out")) == collected(m.ema_points(b.closed_bars(tick_frame(spark, rows))))


def test_following_a_folder_of_events(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for part, prices in enumerate(((42.5, 50.0), (40.0,))):
        lines = []
        for n, price in enumerate(prices):
            at = START + timedelta(minutes=6 * (part * 2 + n), hours=1)
            lines.append(json.dumps({"symbol": "A", "securityType": "E", "price": price, "timestamp": at.strftime("%Y-%m-%dT%H:%M:%S.000")}))
        (folder / f"{part}.ndjson").write_text("\n".join(lines) + "\n\n{broken\n")
    ticks = follow_ndjson(spark, str(folder), 1).where(F.col("status") == ACCEPTED)
    run(crossover.write_points(crossover.stream_points(ticks), f"{tmp_path}/out", f"{tmp_path}/c"))
    points = history(spark, f"{tmp_path}/out").orderBy("window_start").collect()
    assert [(p.close, p.signal) for p in points] == [(42.5, "BUY"), (50.0, None)]
    assert points[0].window_start == START.replace(tzinfo=None)
