"""Sketches by day against exact ranks."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import sketches as k

FRACTIONS = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "top": 1.0}


@pytest.mark.parametrize("shape", ["spread", "ties", "one day of most"])
def test_merged_days_stay_near_the_rank(spark, shape):
    days = "date_add(DATE'2021-11-08', cast(id % 7 as int))"
    if shape == "one day of most":
        days = "CASE WHEN id % 100 < 90 THEN DATE'2021-11-08' ELSE date_add(DATE'2021-11-08', cast(id % 7 as int)) END"
    value = "pmod(xxhash64(id), 4)" if shape == "ties" else "exp(pmod(xxhash64(id), 1000003) / 1e5)"
    rows = spark.range(200_000, numPartitions=6).select(F.expr(days).alias("day"), F.expr(value).cast("double").alias("v"))
    stored = k.day_sketches(rows, "v", ["day"])
    assert stored.count() == 7
    merged = k.sketch_quantiles(stored, FRACTIONS)
    assert merged.first().n == 200_000
    found = k.rank_errors(rows, "v", merged, FRACTIONS).collect()
    assert [r.name for r in found] == list(FRACTIONS)
    assert all(r.error <= k.RANK_ERROR and r.n == 200_000 for r in found)
    assert found[-1].estimate == rows.agg(F.max("v")).first()[0]


def test_few_values_are_exact_and_rest_is_left_out(spark):
    rnd = random.Random(2)
    values = [float(v) for v in rnd.sample(range(10_000), 99)]
    data = [("a", v) for v in values] + [("a", None), ("b", float("nan")), ("b", 3.0), (None, 1.0)]
    frame = spark.createDataFrame(data, "k string, v double")
    found = {r.k: r for r in k.sketch_quantiles(k.day_sketches(frame, "v", ["k"]), {"mid": 0.5}, ["k"]).collect()}
    assert (found["a"].n, found["b"].n, found[None].n) == (99, 1, 1)
    assert found["a"].mid == sorted(values)[49] and found["b"].mid == 3.0


def test_no_rows(spark):
    empty = spark.createDataFrame([], "day date, v long")
    merged = k.sketch_quantiles(k.day_sketches(empty, "v", ["day"]), FRACTIONS)
    assert (merged.first().n, merged.first().p50) == (0, None)
    assert all(r.n == 0 and r.error is None for r in k.rank_errors(empty, "v", merged, FRACTIONS).collect())
