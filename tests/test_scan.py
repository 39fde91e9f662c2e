"""Blocked scans against plain Python, with blocks small enough to matter."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import scan


def test_running_and_neighbours(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("aab"), i, rnd.randrange(1000)) for i in range(500)]
    frame = spark.createDataFrame(rows, "k string, o long, v long").withColumn("w", F.col("v"))
    got = scan.running(
        frame, keys=["k"], order="o", block=F.expr("o div 13"), values={"top": ("v", "max"), "total": ("w", "sum")}
    )
    near = scan.neighbours(
        frame, keys=["k"], order="o", block=F.expr("o div 13"), before={"pv": "v", "po": "o"}, after={"nv": "v"}
    )
    found = {r.o: (r.top, r.total) for r in got.collect()}
    beside = {r.o: (r.pv, r.po, r.nv) for r in near.collect()}
    for key in "ab":
        mine = [r for r in rows if r[0] == key]
        for i, (_, o, _) in enumerate(mine):
            earlier = [v for _, _, v in mine[:i]]
            assert found[o] == (max(earlier, default=None), sum(earlier) if earlier else None)
            before = mine[i - 1] if i else (None, None, None)
            after = mine[i + 1][2] if i + 1 < len(mine) else None
            assert beside[o] == (before[2], before[1], after)


def test_value_blocks_follow_the_values(spark):
    rnd = random.Random(4)
    values = [rnd.choice([-1, 1]) * rnd.lognormvariate(0, 20) for _ in range(3000)] + [0.0, 1.0, 2.0, 0.5, -1.0, 1e300, 5e-324]
    frame = spark.createDataFrame([(v,) for v in values], "v double").withColumn("b", scan.value_block(F.col("v")))
    blocks = [r.b for r in frame.orderBy("v").collect()]
    assert blocks == sorted(blocks)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001])
def test_quantiles(spark, n):
    rnd = random.Random(n)
    values = sorted(rnd.choice([round(rnd.uniform(-5, 500), 1), 7.0, 7.0]) for _ in range(n))
    frame = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    fractions = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    linear = scan.quantiles(frame, "v", fractions, ["k"]).collect()[0]
    nearest = scan.quantiles(frame, "v", fractions, nearest=True).collect()[0]
    for name, f in fractions.items():
        place = (n - 1) * f
        low, high = math.floor(place), math.ceil(place)
        assert linear[name] == pytest.approx(values[low] + (values[high] - values[low]) * (place - low))
        assert nearest[name] == values[round(place)]


def test_ranked(spark):
    rnd = random.Random(8)
    rows = [(f"{rnd.choice('ABC')}{i}", rnd.choice([1, 1, 1, 2, 300, 300, rnd.randrange(100000)])) for i in range(700)]
    frame = spark.createDataFrame(rows, "symbol string, n long")
    got = scan.ranked(frame, "n", "symbol", {"upto": "n"}).orderBy("rank").collect()
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    total = 0
    for place, (row, (symbol, n)) in enumerate(zip(got, expected), 1):
        total += n
        assert (row.rank, row.symbol, row.upto) == (place, symbol, total)


def test_ranges_are_even_whatever_the_names(spark):
    """A value that all rows share, names with a long common beginning, and two names that do not have it."""
    rows = spark.range(20_000).select(F.concat(F.lit("EXCHANGE-SYMBOL-"), F.col("id")).alias("symbol"), F.lit(1).cast("long").alias("n"))
    rows = rows.unionByName(spark.createDataFrame([("A", 1), ("Z", 1)], rows.schema))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = scan._in_ranges(rows, F.col("n").desc(), F.col("symbol").asc())
        sizes = [r["count"] for r in placed.groupBy(F.shiftright("__id", 33)).count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 20_002 / 3
        got = scan.ranked(rows, "n", "symbol", {"upto": "n"}).where("rank IN (1, 2, 10000, 20002)").orderBy("rank").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted(r.symbol for r in rows.collect())
    assert [(r.symbol, r.rank, r.upto) for r in got] == [(names[k - 1], k, k) for k in (1, 2, 10_000, 20_002)]


@pytest.mark.parametrize("accept_open", [False, True])
def test_first_runs(spark, accept_open):
    rnd = random.Random(6)
    rows = []
    for f in range(12):
        state = 0
        for i in range(rnd.randrange(1, 120)):
            if rnd.random() < 0.25:
                state = 1 - state
            rows.append((f"f{f}", i, None if rnd.random() < 0.2 else state))
    frame = spark.createDataFrame(rows, "file string, i long, f int")
    numbered = scan.runs(frame, flag=F.col("f") == 1, order=F.col("i"), block=F.expr("i div 7"), keys=["file"])
    n = 5
    got = {r.file: r.run_start for r in scan.first_run(numbered, n, ["file"], accept_open).collect()}
    nth = {r.file: r.confirmed_at for r in scan.nth_of_first_run(numbered, n, ["file"]).collect()}
    for f in range(12):
        start, run, confirmed = None, [], None
        for _, i, flag in (r for r in rows if r[0] == f"f{f}"):
            if flag == 1:
                run.append(i)
                if len(run) == n and start is None:
                    start, confirmed = run[0], i
            elif flag == 0:
                run = []
        if start is None and accept_open and run:
            start = run[0]
        assert got.get(f"f{f}") == start
        assert nth.get(f"f{f}") == confirmed


def test_affine_chain_by_levels(spark):
    """Every step's start equals the plain chain's, with places of one step and of many."""
    rnd = random.Random(8)
    places = sorted({(rnd.choice("ab"), rnd.randrange(4), rnd.randrange(3), rnd.randrange(40)) for _ in range(300)})
    steps = [(*place, rnd.choice([0.0, 0.5, 1.0, 1e-200]), rnd.uniform(-5, 5)) for place in places]
    frame = spark.createDataFrame(steps, "k string, coarse int, mid int, fine int, weight double, own double")
    got = scan.affine_starts(frame.repartition(5), ["k"], ["coarse", "mid", "fine"], seed=7.0)
    found = {(r.k, r.coarse, r.mid, r.fine): r.start for r in got.collect()}
    assert len(found) == len(steps)
    for key in "ab":
        x = 7.0
        for step in (s for s in steps if s[0] == key):
            assert math.isclose(found[step[:4]], x, rel_tol=1e-12, abs_tol=1e-12)
            x = step[4] * x + step[5]
    assert scan.affine_starts(frame.where("false"), ["k"], ["coarse", "mid", "fine"], seed=7.0).count() == 0
