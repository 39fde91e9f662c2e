"""Files, replay order, cuts, crossings and schedules."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tickloom.functions.times import event_instant
from tickloom.operators import ingest as i
from tickloom.operators import replay as rp
from tickloom.sources import files

HEADER = "ID,SecType,Last,Trading time,Trading date\n"


def utc(text):
    """Wall clock of the market in winter → instant."""
    local = datetime.fromisoformat(text)
    return local.replace(hour=local.hour - 1, tzinfo=timezone.utc)


def five_days(folder):
    """Files named out of order; one holds only zero prices, one only a row without a price."""
    rows = {
        "q3": "LYNX,I,4.5,10:15:00.000,17-01-2023", "q1": "LYNX,I,4.25,09:30:00.000,16-01-2023", "q9": "LYNX,I,0,09:30:00.000,15-01-2023",
        "q2": "LYNX,I,4,11:00:00.000,19-01-2023", "q5": "LYNX,I,,,", "q4": "LYNX,I,3.5,09:45:00.000,18-01-2023",
    }
    for name, row in rows.items():
        (folder / f"ticks-{name}.csv").write_text(f"# from a test\n{HEADER}{row}\n")


def names(rows):
    return [r.source_file.rsplit("-", 1)[1] for r in rows]


def events_of(spark, folder):
    return i.accepted(i.classify(files.read_ticks_csv(spark, str(folder))))


def test_file_order_and_pruning(spark, tmp_path):
    five_days(tmp_path)
    starts = rp.file_starts(events_of(spark, tmp_path))
    assert names(starts.orderBy("file_start").collect()) == ["q1.csv", "q3.csv", "q4.csv", "q2.csv"]

    def pick(start, end):
        return names(rp.select_files(starts, start, end).orderBy("file_start").collect())

    assert pick(utc("2023-01-17T12:00:00"), utc("2023-01-17T12:01:00")) == ["q3.csv"]
    assert pick(utc("2023-01-17T12:00:00"), utc("2023-01-18T09:45:01")) == ["q3.csv", "q4.csv"]
    assert pick(utc("2023-01-20T09:00:00"), None) == ["q2.csv"]
    assert len(pick(None, None)) == 4


def test_arrival_follows_files_then_rows(spark, tmp_path):
    for day in (9, 8):
        rows = "".join(f"S{n},E,{n + 1},08:00:{59 - n % 60:02d}.000,{day:02d}-11-2021\n" for n in range(300))
        (tmp_path / f"{10 - day}.csv").write_text(HEADER + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        arrived = rp.with_arrival(events_of(spark, tmp_path)).orderBy("arrival").select("symbol", "event_ts").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.symbol for r in arrived] == [f"S{n}" for n in range(300)] * 2
    assert {r.event_ts.day for r in arrived[:300]} == {8}


def test_range_is_half_open(spark):
    texts = ["14:59:59.9999", "15:00:00.000", "15:00:00.001", "15:44:59.999", "15:45:00.000"]
    frame = spark.createDataFrame([(f"2023-01-16T{t}",) for t in texts], "t string")
    frame = frame.select("t", event_instant(F.col("t")).alias("event_ts"))
    start, end = utc("2023-01-16T15:00:00"), utc("2023-01-16T15:45:00")
    assert [r.t[11:] for r in rp.replay_range(frame, start, end).collect()] == texts[1:4]
    assert rp.replay_range(frame, start).count() == 4 and rp.replay_range(frame, None, end).count() == 4
    assert rp.replay_range(frame).count() == 5
    for wrong in (start, utc("2023-01-16T14:00:00")):
        with pytest.raises(ValueError):
            rp.replay_range(frame, start, wrong)


def seek_file(path, rows):
    """rows: (wall clock or '', last)."""
    lines = [f"DODO,E,18-01-2023,{at},{last}" if at else ",,,," for at, last in rows]
    path.write_text("\n".join(["# made up", "ID,SecType,Date,Time,Last", *lines, ""]))


def test_seek(spark, tmp_path):
    """Reading starts where so many rows in a row lie at or behind five minutes before the start."""
    start = utc("2023-01-18T10:10:00")
    seek_file(tmp_path / "one.csv", [("08:00:00.000", 10), ("10:04:59.999", 20), ("", 0), ("10:05:00.000", 30), ("", 0), ("09:59:00.000", 40), ("10:10:00.000", 50)])
    seek_file(tmp_path / "two.csv", [("10:20:00.000", 10), ("08:30:00.000", 20), ("10:06:00.000", 30), ("10:07:00.000", 40), ("07:00:00.000", 50)])

    def lasts(name, confirm):
        raw = files.read_ticks_csv(spark, str(tmp_path / name))
        return [r.last for r in rp.seek_start(raw, start, confirm).orderBy("row_id").collect()]

    assert lasts("one.csv", 1) == ["30", None, "40", "50"]
    assert lasts("two.csv", 1) == ["10", "20", "30", "40", "50"]
    assert lasts("two.csv", 2) == ["30", "40", "50"]


def test_stop_after_confirmed_end(spark):
    """A thousand rows in a row a minute or more behind the end stop the replay; any other row starts the count anew."""
    end = utc("2023-01-19T16:20:00")
    seconds = [75] * 400 + [59] + [3600] * 700 + [-30] + [61] * 1000 + [1, -1, 90]
    rows = spark.createDataFrame(list(enumerate(seconds)), "row_id long, s long").select(
        "row_id",
        F.expr("row_id div 64").alias("block_start"),
        F.lit("g").alias("source_file"),
        F.timestamp_seconds(F.lit(int(end.timestamp())) + F.col("s")).alias("event_ts"),
    )
    assert rp.stop_after_end(rows, end).agg(F.max("row_id")).first()[0] == 400 + 1 + 700 + 1 + 1000 - 1
    assert rp.stop_after_end(rows.where("row_id < 2000"), end).count() == 2000


def test_schedule(spark):
    base = datetime(2023, 1, 16, 9, tzinfo=timezone.utc)
    rows = [(5, base), (6, base.replace(minute=1)), (7, base.replace(hour=7)), (8, base.replace(hour=10))]
    frame = spark.createDataFrame(rows, "arrival long, event_ts timestamp")

    def offsets(speed):
        return [r.offset_ns for r in rp.replay_schedule(frame, speed).orderBy("arrival").collect()]

    assert offsets(1.0) == [0, 60 * 10**9, 0, 3600 * 10**9]
    assert offsets(30.0) == [0, 2 * 10**9, 0, 120 * 10**9]
    assert offsets(0) == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        rp.replay_schedule(frame, -0.5)


def test_window_crossings(spark):
    """A tick is a crossing when it is the first of its symbol or moves its newest window on."""
    times = ["09:02:00", "09:04:00", "09:03:59.999", "09:21:30", "09:05:00", "09:24:59.999", "09:25:00"]
    frame = spark.createDataFrame([(10 * n, f"2023-01-17T{t}") for n, t in enumerate(times)], "arrival long, t string")
    frame = frame.select("arrival", F.lit("GNU").alias("symbol"), event_instant(F.col("t")).alias("event_ts"))
    got = rp.window_crossings(frame).orderBy("arrival").collect()
    assert [(r.arrival, r.closes and r.closes.minute) for r in got] == [(0, None), (30, 0), (60, 20)]
