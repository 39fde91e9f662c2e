"""File discovery, CSV and JSON sources, topic records, batch tables."""

import json
import shutil
from datetime import date, datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickloom.operators import history
from tickloom.operators import ingest as i
from tickloom.operators import profile as p
from tickloom.operators.registry import latest_per_key, symbol_list, symbol_search
from tickloom.schemas import POSITIONAL
from tickloom.sources import files, kafka, manifest, tables


def test_discovery(spark, tmp_path):
    for name in ("a.csv", "B.CSV", "c.txt", "sub/d.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    found = lambda *paths: sorted(r.path.rsplit("/", 1)[1] for r in files.discover_inputs(spark, [str(p) for p in paths]).collect())
    assert found(tmp_path) == ["B.CSV", "a.csv"]
    assert found(tmp_path / "c.txt") == ["c.txt"]
    with pytest.raises(AnalysisException):
        found(tmp_path / "missing")


def test_csv_headers_quotes_and_comments(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        '﻿# note\n ID ,SECTYPE,Last,Date,TIME,"Note, long"\nA.X,E,1.5,08-11-2021,09:00:00,"say ""hi"", ok"\n# middle\nB.X,E,,,,\n'
    )
    rows = files.read_ticks_csv(spark, str(tmp_path)).collect()
    assert [r["id"] for r in rows] == ["A.X", "B.X"]
    assert rows[0]["note, long"] == 'say "hi", ok'
    events = i.accepted(i.classify(files.read_ticks_csv(spark, str(tmp_path))))
    assert events.select("symbol", "price").collect() == [("A.X", 1.5)]


def test_every_csv_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,SecType,Last\nA,E,1\n")
    (tmp_path / "b.csv").write_text("# note\nSecType,ID,Last\nI,B,2\nE,C,3\n")
    (tmp_path / "c.csv").write_text("last ,Id,Venue\n4,D,X\n")
    (tmp_path / "d.csv").write_text("ID,SecType,Last\n")
    rows = {r.id: r for r in files.read_ticks_csv(spark, str(tmp_path)).collect()}
    assert {k: (r.sectype, r.last, r.venue) for k, r in rows.items()} == {
        "A": ("E", "1", None), "B": ("I", "2", None), "C": ("E", "3", None), "D": (None, "4", "X"),
    }
    assert [rows[k].row_id < rows["C"].row_id for k in "B"] == [True]


def test_positional_rows(spark, tmp_path):
    def line(**values):
        return ",".join(values.get(c, "") for c in POSITIONAL.fieldNames())

    good = dict(c00="A.X", c01="E", c02="08-11-2021", c03="09:00:00.123", c21="5.0", c22="7", c23="09:00:00.100", c26="08-11-2021")
    rows = [
        "# one\r", "# two\r", "ID,SecType,Date,Time", '"the description, of columns"',
        line(**good), line(**{**good, "c21": ""}), line(**{**good, "c22": "-3"}), "A.X,E,08-11-2021,09:00:01.000",
    ]
    (tmp_path / "a.csv").write_text("\n".join(rows) + "\n")
    facts = p.positional_facts(files.read_positional(spark, str(tmp_path)))
    got = p.symbol_seconds(facts).orderBy("second").collect()
    assert [(r.events, r.price_events, r.volume) for r in got] == [(3, 2, 7.0), (1, 0, 0.0)]


def test_ndjson(spark, tmp_path):
    good = {"symbol": "A", "securityType": "E", "price": 42.5, "timestamp": "2021-11-08T09:00:01.000"}
    (tmp_path / "e.ndjson").write_text(json.dumps(good) + "\n\n{bad\n")
    rows = files.read_ticks_ndjson(spark, str(tmp_path))
    assert sorted(r.status for r in rows.collect()) == ["accepted", "rejected", "skipped"]


def test_topic_records(spark):
    """Offsets repeat over partitions; an event without a type counts, junk is kept with its reason."""
    whole = json.dumps({"symbol": "OX", "securityType": "I", "price": 7.5, "timestamp": "2023-01-17T09:00:01.000"})
    bare = json.dumps({"symbol": "OX", "price": 8, "timestamp": "2023-01-17T09:07:00.000"})
    rows = [(bytearray(whole.encode()), 3, 17), (bytearray(b"junk"), 3, 18), (bytearray(bare.encode()), 1, 17), (None, 1, 18)]
    records = spark.createDataFrame(rows, "value binary, partition int, offset long")
    decoded = kafka.decode_ticks(records)
    assert {(r.partition, r.status, r.reason) for r in decoded.collect()} == {
        (3, "accepted", None), (3, "rejected", "unparseable event"), (1, "accepted", None), (1, "skipped", None),
    }
    ticks = {tuple(t.arrival): (t.symbol, t.security_type, t.price) for t in i.accepted(decoded).collect()}
    assert ticks == {(17, 1): ("OX", "", 8.0), (17, 3): ("OX", "I", 7.5)}


def test_registry_views(spark):
    records = spark.createDataFrame([("b", "1", 1), ("a", "2", 2), ("b", "3", 3), (None, "4", 4)], "key string, value string, o long")
    assert {(r.key, r.value) for r in latest_per_key(records.where("key IS NOT NULL"), "o").collect()} == {("a", "2"), ("b", "3")}
    assert [r.symbol for r in symbol_list(records).collect()] == ["a", "b"]
    registry = spark.createDataFrame([(f"S{n:03d}.NL",) for n in range(300)], "symbol string")
    found = symbol_search(registry, " .nl ").collect()
    assert len(found) == 200 and found[0].matches == 300 and found[0].symbol == "S000.NL"
    assert symbol_search(registry, "").count() == 200
    assert symbol_search(registry, "%").count() == 0


def test_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    start = datetime(2021, 11, 8, 9, tzinfo=timezone.utc)
    rows = [(f"S{n}", start + timedelta(days=n % 2)) for n in range(10)]
    frame = spark.createDataFrame(rows, "symbol string, window_start timestamp")
    for batch in (0, 1, 1, 0):
        tables.write_batch(frame, path, batch, by_day="window_start")
    assert tables.read_history(spark, path).count() == 20


def test_registry_merge(spark, tmp_path):
    path = str(tmp_path / "symbols")
    start = datetime(2021, 11, 8, 9, tzinfo=timezone.utc)
    batch = lambda *names: spark.createDataFrame([(n, "E", start) for n in names], "symbol string, security_type string, first_seen timestamp")
    for number, names in ((0, "ab"), (1, "bc"), (1, "bc"), (2, "abc")):
        tables.append_registry(batch(*names), path, number)
    rows = spark.read.parquet(path).collect()
    assert sorted((r.symbol, r.batch_id) for r in rows) == [("a", 0), ("b", 0), ("c", 1)]


def test_history_is_compacted_pruned_and_expired(spark, tmp_path):
    newest, path = datetime(2023, 3, 30, 12, tzinfo=timezone.utc), str(tmp_path / "h")
    rows = [(s, newest - timedelta(days=n), float(n)) for n in range(30) for s in "CAB"]
    frame = spark.createDataFrame(rows, "symbol string, window_start timestamp, close double")
    for batch in range(4):
        part = frame.where(F.pmod(F.col("close"), F.lit(4)) == batch)
        tables.write_batch(part, path, batch, by_day="window_start")
    before = sorted(map(tuple, tables.read_history(spark, path).select("symbol", "window_start").collect()))
    tables.compact_history(spark, path, date(2023, 3, 28), days=10_000)
    assert sorted(map(tuple, tables.read_history(spark, path).select("symbol", "window_start").collect())) == before
    assert len(list((tmp_path / "h").glob("day=*"))) == 30  # for readers that have begun
    tables.clean_history(spark, path)
    assert len(list((tmp_path / "h").glob("day=*"))) == 3 and len(list((tmp_path / "h_days").glob("commit=*/day=*"))) == 27
    # a micro-batch that runs again writes rows that are compacted already
    tables.write_batch(frame.where("close = 20"), path, 0, by_day="window_start")
    assert tables.read_history(spark, path).count() == len(before)
    at = int((newest - timedelta(days=5)).timestamp() * 1000)
    found = history.history_lookup(tables.read_history(spark, path), "B", at - 3_600_000, at + 3_600_000)
    assert [r.close for r in found.collect()] == [5.0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: ")[1] for line in plan.splitlines() if "PartitionFilters: " in line]
    assert filters and all(">=" in f and "<=" in f for f in filters)
    assert history.day_view(tables.read_history(spark, path), date(2023, 3, 9)).count() == 3
    # rows of a later micro-batch for a compacted day are neither lost nor read twice
    extra = spark.createDataFrame([("D", newest - timedelta(days=5), 99.0)], "symbol string, window_start timestamp, close double")
    for _ in range(2):
        tables.write_batch(extra, path, 7, by_day="window_start")
        assert tables.read_history(spark, path).count() == len(before) + 1
        tables.compact_history(spark, path, date(2023, 3, 28), days=10_000)
    tables.clean_history(spark, path)
    assert tables.read_history(spark, path).count() == len(before) + 1
    tables.compact_history(spark, path, date(2023, 3, 31), days=14)
    kept = tables.read_history(spark, path)
    assert kept.agg(F.min("day")).first()[0] == date(2023, 3, 16)
    assert history.retained(kept.where("symbol <> 'D'")).count() == 14 * 3


def small_history(spark, path, days=4):
    start = datetime(2023, 3, 1, 12, tzinfo=timezone.utc)
    rows = [(s, start + timedelta(days=n), float(n)) for n in range(days) for s in "AB"]
    frame = spark.createDataFrame(rows, "symbol string, window_start timestamp, close double")
    for batch in range(2):
        tables.write_batch(frame.where(F.col("symbol") == "AB"[batch]), path, batch, by_day="window_start")
    return sorted((r[0], r[1].day) for r in rows)


def shown(spark, path):
    return sorted((r.symbol, r.window_start.day) for r in tables.read_history(spark, path).select("symbol", "window_start").collect())


def test_a_compaction_cut_anywhere_leaves_the_old_or_the_new_state(spark, tmp_path, monkeypatch):
    """Two compactions in a row, the second one cut before and after each of its steps."""
    small_history(spark, str(tmp_path / "made/h"))
    made = str(tmp_path / "made/h")
    tables.compact_history(spark, made, date(2023, 3, 3), days=10_000)
    old = shown(spark, made)
    new = [r for r in old if r[1] >= 3]  # the days from the third one on stay
    steps = {"remove": manifest, "commit": manifest, "forget_versions": manifest, "_write_days": tables}
    real = {name: getattr(module, name) for name, module in steps.items()}
    calls = []

    def cut(at, after):
        calls.clear()

        def wrap(name):
            def run(*args, **kwargs):
                calls.append(name)
                if len(calls) == at and not after:
                    raise RuntimeError("cut")
                real[name](*args, **kwargs)
                if len(calls) == at and after:
                    raise RuntimeError("cut")

            return run

        for name, module in steps.items():
            monkeypatch.setattr(module, name, wrap(name))

    total, n = None, 0
    while total is None or n < total:
        for after in (False, True):
            path = str(tmp_path / f"cut{n}{after}/h")
            shutil.copytree(tmp_path / "made", tmp_path / f"cut{n}{after}")
            cut(n, after)
            try:
                tables.compact_history(spark, path, date(2023, 3, 5), days=1)
                assert n == 0
                total = len(calls) + 1
            except RuntimeError:
                pass
            finally:
                monkeypatch.undo()
            found = shown(spark, path)
            assert found in (old, new), (n, after, calls)
            assert (found == new) == (n == 0 or "commit" in calls and (calls[-1] != "commit" or after)), (n, after, calls)
            if after:
                tables.compact_history(spark, path, date(2023, 3, 5), days=1)
                tables.clean_history(spark, path)
                assert shown(spark, path) == new and not list((tmp_path / f"cut{n}{after}/h").glob("day=*"))
        n += 1
    assert {"remove", "commit", "_write_days"} <= set(real) and total >= 5


def test_a_version_is_written_once(spark, tmp_path):
    path = str(tmp_path / "h")
    manifest.commit(spark, path, manifest.Manifest(1, {"2023-03-01": manifest.Day("c", 4)}, "2023-02-01"))
    assert manifest.current(spark, path).holds("2023-03-01", 4) and not manifest.current(spark, path).holds("2023-03-01", 5)
    assert manifest.current(spark, path).holds("2023-01-31", 9)
    with pytest.raises(FileExistsError):
        manifest.commit(spark, path, manifest.Manifest(1, {}, ""))
    manifest.commit(spark, path, manifest.Manifest(2, {}, ""))
    assert manifest.current(spark, path).days == {}


def test_a_lookup_of_one_symbol_skips_most_files_of_a_day(spark, tmp_path):
    start = datetime(2023, 3, 1, tzinfo=timezone.utc)
    rows = spark.range(20_000).selectExpr("concat('S', id % 400) AS symbol", "id")
    rows = rows.select("symbol", (F.lit(start) + F.make_dt_interval(secs=F.col("id"))).alias("window_start"), F.col("id").cast("double").alias("close"))
    path = str(tmp_path / "h")
    tables.write_batch(rows, path, 0, by_day="window_start")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1000")
    try:
        tables.compact_history(spark, path, date(2023, 3, 2))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    ranges = []
    for file in (tmp_path / "h_days").glob("commit=*/day=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
        ranges.append((columns["symbol"].statistics.min, columns["symbol"].statistics.max))
    assert len(ranges) >= 20
    assert sum(low <= "S77" <= high for low, high in ranges) <= 2
    found = history.history_lookup(tables.read_history(spark, path), "S77")
    assert found.count() == 50


def test_runs_and_sparse_csv(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"runs/capacity-{n}").mkdir(parents=True)
        (tmp_path / f"runs/capacity-{n}/summary.json").write_text(json.dumps({"replicas": n, "throughput_eps": 10.0 * n}, indent=1))
    runs = files.read_runs(spark, str(tmp_path / "runs"), "replicas int, throughput_eps double")
    assert sorted((r.run, r.replicas) for r in runs.collect()) == [("capacity-1", 1), ("capacity-2", 2)]
    shapes = [spark.createDataFrame([(1, 2)], "t int, a int"), spark.createDataFrame([(3, 4)], "t int, b int")]
    tables.write_sparse_csv(shapes, str(tmp_path / "s"))
    back = spark.read.option("header", True).csv(str(tmp_path / "s"))
    assert back.columns == ["t", "a", "b"]
    assert back.where(F.col("b") == "4").first().a is None


def test_stored_ticks_are_pruned_by_day(spark, tmp_path):
    start = datetime(2021, 11, 8, tzinfo=timezone.utc)
    rows = [("A", start + timedelta(hours=n), float(n), n) for n in range(120)]
    ticks = spark.createDataFrame(rows, "symbol string, event_ts timestamp, price double, arrival long")
    tables.store_ticks(ticks, str(tmp_path / "t"))
    got = tables.read_ticks(spark, str(tmp_path / "t"), start + timedelta(hours=30), start + timedelta(hours=60))
    assert sorted(r.arrival for r in got.collect()) == list(range(30, 60))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(event_ts)" in plan
    assert tables.read_ticks(spark, str(tmp_path / "t")).count() == 120
