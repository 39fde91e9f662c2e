"""Row validation, text and time functions, JSON events."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tickloom.functions import event_instant, iso_local, local_to_instant, parse_local, partition_of, wall_clock
from tickloom.operators import ingest as i

HEADER = ["id", "sectype", "date", "time", "last", "trading time", "trading date"]
GOOD = ["LYNX.FR", "I", "16-01-2023", "09:30:05.250", "87.5", "09:30:05.250", "16-01-2023"]


def changed(**values):
    row = dict(zip(HEADER, GOOD))
    row.update({k.replace("_", " "): v for k, v in values.items()})
    return [row[h] for h in HEADER]


CASES = [
    (changed(), "accepted", None),
    (changed(trading_date=None), "accepted", None),
    (changed(trading_time="  "), "accepted", None),
    (changed(last=None), "skipped", "non-price event: missing last"),
    (changed(last=" \t"), "skipped", "non-price event: missing last"),
    (changed(id="", last=""), "skipped", "non-price event: missing last"),
    (changed(last="12,5"), "rejected", "invalid price: 12,5"),
    (changed(last="0.00"), "rejected", "invalid price: 0.00"),
    (changed(last="-87.5"), "rejected", "invalid price: -87.5"),
    (changed(last="NaN"), "rejected", "invalid price: NaN"),
    (changed(last="Infinity"), "rejected", "invalid price: Infinity"),
    (changed(id=" "), "rejected", "missing required field: id"),
    (changed(sectype=None), "rejected", "missing required field: sectype"),
    (changed(trading_time="09:30:05.2501"), "accepted", None),
    (changed(trading_time="09:30:05"), "accepted", None),
    (changed(trading_date=None, date=None), "rejected", "missing required field: date"),
    (changed(trading_date=None, time=""), "rejected", "missing required field: time"),
    (changed(trading_date="16-13-2023"), "rejected", "invalid date: 16-13-2023"),
    (changed(trading_time="25:00:00"), "rejected", "invalid timestamp: 16-01-2023 25:00:00"),
    (changed(trading_date="30-02-2024"), "accepted", None),
    (changed(trading_time="24:00:00"), "accepted", None),
]


def raw(spark):
    rows = [(n, *row) for n, (row, _, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "n long, " + ", ".join(f"`{h}` string" for h in HEADER))


def test_every_rule(spark):
    got = {r.n: r for r in i.classify(raw(spark)).collect()}
    for n, (row, status, reason) in enumerate(CASES):
        assert (got[n].status, got[n].reason) == (status, reason), row


def test_event_values(spark):
    events = i.accepted(i.classify(raw(spark))).orderBy("n")
    first = events.first()
    assert (first.symbol, first.security_type, first.price) == ("LYNX.FR", "I", 87.5)
    assert first.event_ts == datetime(2023, 1, 16, 8, 30, 5, 250000)
    texts = {r.n: r.t for r in events.select("n", iso_local(F.col("local_ts")).alias("t")).collect()}
    assert texts[0] == "2023-01-16T09:30:05.250"
    assert texts[13] == "2023-01-16T09:30:05.2501"
    assert texts[19] == "2024-02-29T09:30:05.250"
    assert texts[20] == "2023-01-17T00:00:00.000"


def test_counters_travel_with_another_action(spark):
    observed, counts = i.observe_counts(i.classify(raw(spark)))
    assert i.quarantine(observed).count() == counts.get["rejected"] == 11
    assert counts.get["accepted"] == 7 and counts.get["skipped"] == 3
    assert [r.n for r in i.first_rejects(i.classify(raw(spark)), "n", 3).collect()] == [6, 7, 8]


def test_a_missing_column_counts_as_blank(spark):
    frame = raw(spark).drop("trading date", "trading time", "sectype").limit(1)
    assert i.classify(frame).first().reason == "missing required field: sectype"


def test_filters_do_not_repeat_the_parsing(spark):
    plan = i.accepted(i.classify(raw(spark)))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert len(filters) == 1 and "timestamp" not in filters[0]


def test_json_both_ways(spark):
    events = i.accepted(i.classify(raw(spark))).where("n = 13")
    record = i.event_json(events).first()
    assert record.key == "LYNX.FR"
    assert json.loads(record.value) == {
        "symbol": "LYNX.FR", "securityType": "I", "price": 87.5, "timestamp": "2023-01-16T09:30:05.2501"
    }
    lines = [record.value, "", "  ", "{broken", '{"symbol":"A"}', '{"symbol":"A","securityType":"E","price":1,"timestamp":"x"}']
    back = i.parse_event_json(spark.createDataFrame([(n, s) for n, s in enumerate(lines)], "n long, value string"))
    got = {r.n: r for r in back.collect()}
    assert [got[n].status for n in range(6)] == ["accepted", "skipped", "skipped", "rejected", "rejected", "rejected"]
    assert got[0].event_ts == events.first().event_ts and got[0].price == 87.5
    assert back.select(i.symbol_of(F.lit(lines[4])).alias("s")).first().s == "A"


def test_clock_changes(spark):
    frame = spark.createDataFrame([("31-10-2021", "02:30:00"), ("28-03-2021", "02:30:00")], "d string, t string")
    local = parse_local(F.col("d"), F.col("t"))
    got = [r[0] for r in frame.select(local_to_instant(local)).collect()]
    assert got == [datetime(2021, 10, 31, 0, 30), datetime(2021, 3, 28, 1, 30)]


def test_instants_in_text(spark):
    texts = ["2023-01-17T06:05:04.030", "2023-07-17T06:05:04.030", "2023-01-17T06:05:04.03Z", "2023-01-17T06:05:04-03:30", "2023-01-17T06:05", "noon"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(event_instant(F.col("t")).alias("i"))
    want = [(1, 5, 5, 4, 30000), (7, 4, 5, 4, 30000), (1, 6, 5, 4, 30000), (1, 9, 35, 4, 0), (1, 5, 5, 0, 0)]
    assert [r.i for r in frame.collect()] == [datetime(2023, m, 17, h, n, s, u) for m, h, n, s, u in want] + [None]
    summer = spark.range(1).select(wall_clock(F.lit(datetime(2023, 7, 17, 10, tzinfo=timezone.utc))).alias("w")).first().w
    assert summer == "2023-07-17T12:00:00.000"


@pytest.mark.parametrize("partitions", [1, 6, 13])
def test_topic_partition(spark, partitions):
    # Known values of the 32-bit hash, sign bit cleared.
    known = {"21": -973932308, "foobar": -790332482, "a-little-bit-long-string": -985981536, "abc": 479470107}
    frame = spark.createDataFrame([(k,) for k in known], "k string")
    got = {r.k: r.p for r in frame.select("k", partition_of(F.col("k"), partitions).alias("p")).collect()}
    assert got == {k: (v & 0x7FFFFFFF) % partitions for k, v in known.items()}
