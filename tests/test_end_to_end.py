"""Daily CSV files → validated ticks → partitions → closed points, against the model."""

from datetime import datetime, timedelta

from model import closed_points
from pyspark.sql import functions as F
from test_bars import collected, staged_rows

from tickloom.functions.hashing import partition_of
from tickloom.operators import bars, ema, history, ingest, registry, replay
from tickloom.sources import read_ticks_csv

LOCAL = datetime(2021, 11, 8, 9)  # 08:00 UTC on the market's clock


def test_files_to_points(spark, tmp_path):
    rows = staged_rows()
    half = len(rows) // 2
    for name, part in (("b.csv", rows[:half]), ("a.csv", rows[half:])):
        lines = ["# tick file", "ID,SecType,Date,Time,Last,Trading time,Trading date"]
        for n, (symbol, _, seconds, price) in enumerate(part):
            at = LOCAL + timedelta(seconds=seconds)
            clock, day = at.strftime("%H:%M:%S.000"), at.strftime("%d-%m-%Y")
            trading = ("", "") if n % 3 == 0 else (clock, day)
            lines.append(f"{symbol},E,{day},{clock},{price},{trading[0]},{trading[1]}")
            if n % 10 == 0:
                lines += [f"{symbol},E,{day},{clock},,,", f"{symbol},E,{day},{clock},-5,,", ",,,,,,"]
        (tmp_path / name).write_text("\n".join(lines) + "\n")

    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        rows_read = ingest.classify(read_ticks_csv(spark, str(tmp_path)))
        ticks = registry.with_topic_partition(replay.with_arrival(ingest.accepted(rows_read)), 3)
        points = ema.ema_points(bars.closed_bars(ticks)).cache()
        symbols = sorted({r[0] for r in rows})
        frame = spark.createDataFrame([(s,) for s in symbols], "s string")
        place = {r.s: r.p for r in frame.select("s", partition_of(F.col("s"), 3).alias("p")).collect()}
        base = int((LOCAL - timedelta(hours=1) - datetime(1970, 1, 1)).total_seconds() * 1000)
        expected = closed_points([(s, place[s], base + sec * 1000, p) for s, _, sec, p in rows])
        assert collected(points) == expected
        partial = spark.createDataFrame([(s,) for s in symbols[:2]], "symbol string")
        again = registry.with_topic_partition(ticks.drop("partition"), 3, partial)
        assert {(r.symbol, r.partition) for r in again.select("symbol", "partition").distinct().collect()} == set(place.items())
        assert again.count() == len(rows)
        found = {r.symbol: r.first_seen for r in registry.symbol_registry(ticks).collect()}
        assert set(found) == set(symbols) and min(found.values()) == datetime(2021, 11, 8, 8, 0, 12)
        counts = {r.status: r.n for r in rows_read.groupBy("status").agg(F.count("*").alias("n")).collect()}
        assert counts["accepted"] == len(rows) and counts["rejected"] == counts["skipped"] // 2
        newest = history.history_lookup(points, "DIP", limit=5).collect()
        assert [r.close for r in newest] == [90.0] * 5
        assert newest == sorted(newest, key=lambda r: r.window_start)
        start = base + 79 * 300_000
        assert history.history_lookup(points, "DIP", start, start).count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
