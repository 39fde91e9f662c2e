"""Every operator as a query over the given tables: name → (spark, folder) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.hashing import partition_of
from tickloom.functions.times import wall_clock
from tickloom.operators import bars as b
from tickloom.operators import ema as m
from tickloom.operators import history as h
from tickloom.operators import ingest as i
from tickloom.operators import lateness as late
from tickloom.operators import profile as p
from tickloom.operators import registry as r
from tickloom.operators import replay as rp
from tickloom.operators import sketches as k
from tickloom.operators import telemetry as t
from tickloom.operators.scan import arrival_block, running
from tickloom.plans import inputs as src
from tickloom.plans.inputs import DAYS, plain
from tickloom.schemas import POINT_JSON_DDL, POSITIONAL
from tickloom.session import work_dir
from tickloom.sources import files, kafka, tables
from tickloom.streaming import crossover, exact, metrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FROM = datetime(2024, 1, 10, 6, tzinfo=timezone.utc)
TO = datetime(2024, 1, 12, 18, tzinfo=timezone.utc)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- bars, averages, signals ---------------------------------------------------


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return m.ema_points(b.closed_bars(src.ticks(spark, sf), late_free=True))


@query
def bars_5m(spark, sf):
    return plain(b.bars(src.ticks(spark, sf)))


@query
def bars_closed_only(spark, sf):
    return plain(b.closed_bars(src.ticks(spark, sf, shuffled=True)))


@query
def bars_with_grace(spark, sf):
    kept = b.drop_late(src.ticks(spark, sf, shuffled=True), grace="10 minutes")
    return plain(b.bars(kept))


@query
def ema_points(spark, sf):
    return plain(_points(spark, sf), 6)


@query
def advisories(spark, sf):
    return plain(m.advisories(_points(spark, sf)), 6)


@query
def advisories_after_late_drop(spark, sf):
    kept = b.closed_bars(src.ticks(spark, sf, by="user", shuffled=True))
    return plain(m.advisories(m.ema_points(kept)), 6)


@query
def signals_by_lag(spark, sf):
    stored = _points(spark, sf).drop("signal")
    return plain(m.signals_by_lag(stored), 6)


@query
def ema_by_day(spark, sf):
    return plain(m.ema_by_day(b.bars(src.ticks(spark, sf)), 38), 6)


@query
def ema_by_minute(spark, sf):
    """Many bars a day: several blocks, each with weights of its own."""
    return plain(m.ema_by_day(b.bars(src.ticks(spark, sf), "1 minute"), 3), 6)


@query
def ema_of_one(spark, sf):
    return plain(m.ema_by_day(b.bars(src.ticks(spark, sf)), 1), 6)


@query
def point_records(spark, sf):
    records = h.point_records(_points(spark, sf))
    return plain(records.select("key", F.from_json("value", POINT_JSON_DDL).alias("v")).select("key", "v.*"), 6)


# -- registry and history ------------------------------------------------------


@query
def symbol_registry(spark, sf):
    return plain(r.symbol_registry(src.ticks(spark, sf, by="user", shuffled=True)))


@query
def symbol_search(spark, sf):
    return r.symbol_search(r.symbol_registry(src.ticks(spark, sf, by="user")), " 2.CL ")


@query
def symbol_list(spark, sf):
    return r.symbol_list(r.registry_records(r.symbol_registry(src.ticks(spark, sf, by="user"))))


@query
def new_symbols(spark, sf):
    ticks = src.ticks(spark, sf, by="user")
    split = F.lit(datetime(2024, 1, 3, tzinfo=timezone.utc))
    known = r.symbol_registry(ticks.where(F.col("event_ts") < split))
    return plain(r.new_symbols(r.symbol_registry(ticks), known))


@query
def latest_per_key(spark, sf):
    ticks = src.ticks(spark, sf, by="user", shuffled=True)
    records = ticks.select(F.col("symbol").alias("key"), F.col("price").alias("value"), "arrival")
    return r.latest_per_key(records, "arrival")


@query
def topic_partitions(spark, sf):
    symbols = src.ticks(spark, sf, by="user").select("symbol").distinct()
    return symbols.withColumn("partition", partition_of(F.col("symbol"), 6))


@query
def partition_skew(spark, sf):
    return plain(r.partition_skew(src.ticks(spark, sf, by="user"), 6), 6)


@query
def history_lookup(spark, sf):
    start, end = (int(x.timestamp() * 1000) for x in (FROM, TO))
    return plain(h.history_lookup(_points(spark, sf), "view", start, end, limit=100), 6)


@query
def history_day(spark, sf):
    return plain(h.day_view(_points(spark, sf), date(2024, 1, 9)), 6)


@query
def history_days(spark, sf):
    return h.days(_points(spark, sf), zone="Europe/Amsterdam")


@query
def history_retained(spark, sf):
    return plain(h.retained(_points(spark, sf)), 6)


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """The points as the stream stores them: in several micro-batches, the older days compacted."""
    path = f"{work_dir(spark, 'history')}/points"
    points = _points(spark, sf).withColumn("part", F.pmod(F.xxhash64("symbol", "window_start"), F.lit(3)))
    for n in range(3):
        tables.write_batch(points.where(F.col("part") == n).drop("part"), path, n, by_day="window_start")
    tables.compact_history(spark, path, date(2024, 1, 12), days=10_000)
    return tables.read_history(spark, path)


@query
def stored_history_lookup(spark, sf):
    start, end = (int(x.timestamp() * 1000) for x in (FROM, TO))
    return plain(h.history_lookup(_history(spark, sf), "view", start, end, limit=100).drop("day"), 6)


@query
def stored_history_day(spark, sf):
    return plain(h.day_view(_history(spark, sf), date(2024, 1, 9)).drop("day"), 6)


@query
def stored_history_retained(spark, sf):
    return plain(h.retained(_history(spark, sf)).drop("day"), 6)


@query
def session_breaks(spark, sf):
    return plain(h.session_breaks(_points(spark, sf)).select("symbol", "window_start", "day", "previous_day"))


@query
def latest_points(spark, sf):
    return plain(h.latest_points(_points(spark, sf)), 6)


@query
def point_table(spark, sf):
    return plain(h.point_table(_points(spark, sf)), 6)


# -- lateness ------------------------------------------------------------------


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    return b.with_stream_time(src.ticks(spark, sf, shuffled=True))


@query
def late_events(spark, sf):
    found = late.late_events(_marked(spark, sf))
    return plain(found.select("symbol", "arrival", "event_ts", "window_start", "stream_time", "lag_ms"))


@query
def late_by_window(spark, sf):
    return plain(late.late_by_window(_marked(spark, sf)))


@query
def late_totals(spark, sf):
    return plain(late.late_totals(_marked(spark, sf), src.table(spark, sf, "events")), 9)


@query
def late_percentiles(spark, sf):
    return late.late_percentiles(_marked(spark, sf))


@query
def grace_recovery(spark, sf):
    return late.grace_recovery(_marked(spark, sf))


@query
def counterfactual_compare(spark, sf):
    return plain(late.compare_points(late.both_points(_marked(spark, sf))), 6)


@query
def late_by_hour(spark, sf):
    return plain(late.late_by_hour(_marked(spark, sf)), 9)


@query
def replay_span(spark, sf):
    return plain(late.replay_span_ms(src.ticks(spark, sf, shuffled=True)))


# -- ingest --------------------------------------------------------------------


@query
def ingest_classify(spark, sf):
    return i.status_counts(i.classify(src.raw_rows(spark, sf)))


@query
def ingest_events(spark, sf):
    return plain(i.accepted(i.classify(src.raw_rows(spark, sf))))


@query
def ingest_first_rejects(spark, sf):
    rejected = i.first_rejects(i.classify(src.raw_rows(spark, sf)), "event_id")
    return rejected.select("event_id", "reason")


@query
def ingest_observed(spark, sf):
    """Rows counted by the pass that stores the accepted ones."""
    out = work_dir(spark, "accepted")
    rows, seen = i.observe_counts(i.classify(src.raw_rows(spark, sf)))
    i.accepted(rows).write.parquet(out)
    counts = [F.lit(seen.get[s]).cast("bigint").alias(s) for s in (i.ACCEPTED, i.SKIPPED, i.REJECTED)]
    return spark.read.parquet(out).agg(F.count("*").alias("stored")).select("stored", *counts)


@query
def csv_ingest(spark, sf):
    out = work_dir(spark, "csv")
    src.raw_rows(spark, sf).drop("event_id").withColumnsRenamed({"id": " ID", "sectype": "SecType"}).write.option(
        "header", True
    ).csv(out)
    return i.status_counts(i.classify(files.read_ticks_csv(spark, out)))


@query
def csv_mixed_headers(spark, sf):
    """Two deliveries of one folder whose columns are in another order."""
    out = work_dir(spark, "mixed")
    raw = src.raw_rows(spark, sf)
    for rest, columns in ((0, raw.columns), (1, raw.columns[::-1])):
        half = raw.where(F.col("event_id") % 2 == rest).select(*[F.col(f"`{c}`") for c in columns if c != "event_id"])
        half.write.mode("append").option("header", True).csv(out)
    return i.status_counts(i.classify(files.read_ticks_csv(spark, out)))


@query
def mixed_inputs_order(spark, sf):
    """CSV files come before NDJSON files, whatever their times; inside a file the rows keep their order."""
    out = work_dir(spark, "inputs")
    raw = src.raw_rows(spark, sf).repartitionByRange("event_id").sortWithinPartitions("event_id")
    several = {"maxRecordsPerFile": 5000}
    csv = raw.where("event_id % 2 = 1").drop("event_id")
    csv.write.options(header=True, **several).csv(f"{out}/csv")
    lines = i.event_json(i.accepted(i.classify(raw.where("event_id % 2 = 0"))))
    lines.select("value").write.options(**several).text(f"{out}/ndjson")
    ticks = rp.with_arrival(i.accepted(files.read_inputs(spark, f"{out}/csv", f"{out}/ndjson"))).withColumn("one", F.lit(1))
    placed = running(ticks, order="arrival", block=arrival_block(ticks), values={"place": ("one", "sum")}, inclusive=True)
    return plain(placed.select("place", "symbol", "price", "event_ts"))


@query
def followed_ndjson(spark, sf):
    out = work_dir(spark, "followed")
    i.event_json(i.accepted(i.classify(src.raw_rows(spark, sf)))).select("value").write.text(f"{out}/in")
    ticks = files.follow_ndjson(spark, f"{out}/in", 1).where("status = 'accepted'")
    writer = ticks.select("symbol", "security_type", "price", "event_ts").writeStream.option("checkpointLocation", f"{out}/c")
    writer.trigger(availableNow=True).start(path=f"{out}/rows", format="parquet").awaitTermination()
    return plain(spark.read.parquet(f"{out}/rows"))


@query
def ndjson_ingest(spark, sf):
    out = work_dir(spark, "ndjson")
    events = i.accepted(i.classify(src.raw_rows(spark, sf)))
    i.event_json(events).select("value").write.text(out)
    back = i.accepted(files.read_ticks_ndjson(spark, out))
    return plain(back.select("symbol", "security_type", "price", "event_ts"))


@query
def topic_decode(spark, sf):
    decoded = kafka.decode_ticks(src.topic_records(spark, sf))
    columns = ["partition", "arrival.offset", "status", "reason", "symbol", "security_type", "price", "event_ts"]
    return plain(decoded.select(*columns).where("status <> 'rejected'").unionByName(decoded.where("status = 'rejected'").select(
        "partition", "arrival.offset", "status", "reason", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("symbol", "string"), ("security_type", "string"), ("price", "double"), ("event_ts", "timestamp"))]
    )))


@query
def window_crossings_by_topic(spark, sf):
    ticks = i.accepted(kafka.decode_ticks(src.topic_records(spark, sf))).repartition(7, "price")  # no order to rely on
    found = rp.window_crossings(ticks)
    return plain(found.select("arrival.offset", "arrival.partition", "symbol", "event_ts", "window_start", "closes"))


@query
def positional_ingest(spark, sf):
    out = work_dir(spark, "positional")
    named = {"c00": "id", "c01": "sectype", "c02": "date", "c03": "time", "c21": "last", "c22": "last", "c23": "trading time", "c26": "trading date"}
    raw = src.raw_rows(spark, sf)
    wide = [F.col(f"`{named[c]}`") if c in named else F.lit("") for c in POSITIONAL.fieldNames()]
    raw.select(*[w.alias(c) for w, c in zip(wide, POSITIONAL.fieldNames())]).write.option("emptyValue", "").csv(out)
    facts = p.positional_facts(files.read_positional(spark, out))
    return plain(p.second_totals(p.symbol_seconds(facts)), 4)


@query
def symbol_of_json(spark, sf):
    records = i.event_json(src.ticks(spark, sf, by="user").withColumn("local_ts", F.col("event_ts")))
    return records.groupBy(i.symbol_of(F.col("value")).alias("symbol")).agg(F.count("*").alias("events"))


@query
def wall_clock_text(spark, sf):
    ticks = src.ticks(spark, sf)
    return ticks.select("arrival", wall_clock(F.col("event_ts")).alias("local"), F.unix_millis("event_ts").alias("ms"))


# -- replay --------------------------------------------------------------------


@query
def replay_range(spark, sf):
    return plain(rp.replay_range(src.ticks(spark, sf), FROM, TO))


@query
def file_order(spark, sf):
    return plain(rp.file_starts(src.filed(spark, sf).where("price > 0")))


@query
def file_selection(spark, sf):
    return plain(rp.select_files(rp.file_starts(src.filed(spark, sf).where("price > 0")), FROM, TO))


@query
def arrival_close(spark, sf):
    rows = src.filed(spark, sf).where("price > 0").withColumn("symbol", F.lit("all"))
    return plain(b.bars(rp.with_arrival(rows)))


@query
def seek_start(spark, sf):
    kept = rp.seek_start(src.filed(spark, sf), FROM, confirm_rows=5, zone="UTC")
    return plain(kept.select("source_file", "row_id", "event_ts"))


@query
def stop_after_end(spark, sf):
    kept = rp.stop_after_end(src.filed(spark, sf), TO, confirm_rows=4)
    return plain(kept.select("source_file", "row_id", "event_ts"))


@query
def replay_schedule(spark, sf):
    return rp.replay_schedule(src.ticks(spark, sf, shuffled=True), 100.0).select("arrival", "offset_ns")


@query
def window_crossings(spark, sf):
    return plain(rp.window_crossings(src.ticks(spark, sf, shuffled=True)))


# -- dataset profile -----------------------------------------------------------


def _sym_sec(spark, sf):
    return p.symbol_seconds(src.facts(spark, sf))


def _sym_min(spark, sf):
    return p.symbol_minute(_sym_sec(spark, sf))


def _minutes(spark, sf):
    return p.minute_totals(_sym_sec(spark, sf))


def _seconds(spark, sf):
    return p.second_totals(_sym_sec(spark, sf))


def _symbols(spark, sf):
    return p.symbol_totals(_sym_min(spark, sf))


def _stored(rollup: DataFrame) -> DataFrame:
    """A rollup written once and read back, for reports that use it several times: one pass over the ticks."""
    spark = rollup.sparkSession
    out = work_dir(spark, "rollup")
    rollup.write.parquet(out)
    return spark.read.schema(rollup.schema).parquet(out)


@query
def symbol_seconds(spark, sf):
    return plain(_sym_sec(spark, sf), 4)


@query
def second_totals(spark, sf):
    return plain(_seconds(spark, sf), 4)


@query
def symbol_minute(spark, sf):
    return plain(_sym_min(spark, sf), 4)


@query
def minute_totals(spark, sf):
    return plain(_minutes(spark, sf), 4)


@query
def symbol_totals(spark, sf):
    return plain(_symbols(spark, sf), 4)


@query
def profile_totals(spark, sf):
    sym_sec = _stored(_sym_sec(spark, sf))
    return plain(p.profile_totals(p.minute_totals(sym_sec), p.symbol_totals(p.symbol_minute(sym_sec))), 4)


@query
def by_day(spark, sf):
    return plain(p.by_day(_minutes(spark, sf)), 4)


@query
def by_exchange(spark, sf):
    return p.by_exchange(_symbols(spark, sf))


@query
def symbol_stats(spark, sf):
    return plain(p.symbol_stats(_stored(_symbols(spark, sf))), 6)


@query
def symbol_bins(spark, sf):
    return plain(p.symbol_bins(_stored(_symbols(spark, sf))), 6)


@query
def minute_series(spark, sf):
    return plain(p.minute_series(_minutes(spark, sf)), 4)


@query
def minute_of_day(spark, sf):
    return plain(p.minute_of_day(_minutes(spark, sf)), 6)


@query
def peak_minutes(spark, sf):
    return plain(p.peaks(_minutes(spark, sf), "ts", "events"), 4)


@query
def peak_price_minutes(spark, sf):
    return plain(p.peaks(_minutes(spark, sf), "ts", "price_events"), 4)


@query
def peak_seconds(spark, sf):
    return plain(p.peaks(_seconds(spark, sf), "second", "events"), 4)


@query
def peak_price_seconds(spark, sf):
    return plain(p.peaks(_seconds(spark, sf), "second", "price_events"), 4)


@query
def second_percentiles(spark, sf):
    return plain(p.second_percentiles(_stored(_seconds(spark, sf))), 9)


def _near(rows, value, day, fractions):
    """Quantiles merged from sketches by day: how many rows they stand for and whether their ranks are near enough."""
    sketches = _stored(k.day_sketches(rows.withColumn("day", day), value, ["day"]))
    errors = k.rank_errors(rows, value, k.sketch_quantiles(sketches, fractions), fractions)
    return errors.select("name", "fraction", "n", F.coalesce(F.col("error") <= k.RANK_ERROR, F.lit(True)).alias("near"))


@query
def sketched_seconds(spark, sf):
    """Events a second, sketched by day and merged over all days."""
    seconds = _stored(_seconds(spark, sf))
    return _near(seconds, "events", F.to_date("second"), {"p50": 0.5, "p90": 0.9, "p99": 0.99, "max": 1.0})


@query
def sketched_lags(spark, sf):
    """Lags of late events, sketched by day and merged over all days."""
    lags = _stored(late.late_events(_marked(spark, sf)).select("window_end", "lag_ms"))
    return _near(lags, "lag_ms", F.to_date("window_end"), {**late.LAG_FRACTIONS, "max": 1.0})


@query
def top_by_events(spark, sf):
    return plain(p.top_symbols(_symbols(spark, sf), "events"), 4)


@query
def top_by_price(spark, sf):
    return plain(p.top_symbols(_symbols(spark, sf), "price_events"), 4)


@query
def tracked_symbols(spark, sf):
    return p.tracked_symbols(_stored(_symbols(spark, sf)))


@query
def tracked_series(spark, sf):
    return plain(p.tracked_series(_sym_min(spark, sf), p.tracked_symbols(_stored(_symbols(spark, sf)))))


@query
def concentration(spark, sf):
    return plain(p.concentration(_stored(_symbols(spark, sf))), 9)


@query
def price_ranking(spark, sf):
    return plain(p.price_ranking(_stored(_symbols(spark, sf))), 9)


@query
def dense_grid(spark, sf):
    minutes = _stored(_minutes(spark, sf))
    start = p.anchor(minutes).scalar()
    series = minutes.select(F.lit("all").alias("name"), F.col("ts").alias("t"), "events", "price_events")
    return plain(p.dense(series, ["name"], start, "15 minutes", 7 * 96))


def _rollups(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], str]:
    """The three rollups written and read again, as a summary that resumes from them does."""
    out = work_dir(spark, "profile")
    p.write_rollups(src.facts(spark, sf), out)
    return p.read_rollups(spark, out), out


@query
def distinct_symbols_by_span(spark, sf):
    """Different symbols of every day and of every three days, from bitmaps kept by day."""
    sym_min = _stored(_sym_min(spark, sf))
    bitmaps = _stored(p.day_bitmaps(sym_min, _stored(p.symbol_numbers(sym_min))))
    days = bitmaps.select("day").distinct()
    spans = days.select(F.col("day").alias("first"), F.explode(F.array(F.lit(0), F.lit(2))).alias("more"))
    return p.distinct_in_spans(bitmaps, spans.select("first", F.date_add("first", F.col("more")).alias("last")))


@query
def refreshed_rollups(spark, sf):
    """Second totals of stored ticks that grew by a part of a day, collapsed again for that day only."""
    out = work_dir(spark, "grown")
    ticks = src.ticks(spark, sf, by="user")
    of_day = F.to_date("event_ts") == F.lit(date(2024, 1, 12))
    for part in (ticks.where(~of_day | (F.hour("event_ts") < 7)), ticks.where(of_day)):
        tables.store_ticks(part, f"{out}/ticks")
        p.refresh_seconds(spark, f"{out}/ticks", f"{out}/rollups", p.facts_of_ticks)
    return plain(p.second_totals(p.refreshed_seconds(spark, f"{out}/rollups")), 4)


@query
def stored_minute_totals(spark, sf):
    return plain(_rollups(spark, sf)[0]["minute_totals"], 4)


@query
def resumed_totals(spark, sf):
    return plain(p.summary(_rollups(spark, sf)[0])["totals"], 4)


@query
def summary_files(spark, sf):
    rollups, out = _rollups(spark, sf)
    p.write_summary(rollups, out)
    return plain(spark.read.schema("day DATE, events BIGINT, price_events BIGINT, volume DOUBLE").json(f"{out}/summary/by_day"), 4)


@query
def ranking_file(spark, sf):
    rollups, out = _rollups(spark, sf)
    p.write_summary(rollups, out)
    schema = p.price_ranking(p.symbol_totals(rollups["symbol_minute"])).schema
    return plain(spark.read.schema(schema).option("header", True).csv(f"{out}/price_events_by_symbol"), 9)


@query
def sparse_rows(spark, sf):
    """Rows of two shapes in one CSV file set."""
    out = f"{work_dir(spark, 'sparse')}/rows"
    events = src.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("key"), "event_type")
    orders = src.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderstatus").alias("status"))
    tables.write_sparse_csv([events, orders], out)
    return spark.read.option("header", True).csv(out)


@query
def tracked_records(spark, sf):
    sym_min = _stored(_sym_min(spark, sf))
    start = p.anchor(sym_min).scalar()
    records = p.tracked_records(p.symbol_totals(sym_min), sym_min, start, 31 * 4, "6 hours")
    listed = {c: F.array_join(c, ",") for c in ("events_series", "price_series")}
    return plain(records.withColumns(listed), 4)


# -- telemetry -----------------------------------------------------------------

SERIES = ["run", "service", "container"]


@query
def counter_rate(spark, sf):
    return plain(t.counter_rate(src.samples(spark, sf), SERIES, "cpu_usage_us", DAYS), 6)


@query
def per_second_rate(spark, sf):
    rates = t.counter_rate(src.samples(spark, sf), SERIES, "cpu_usage_us", DAYS)
    return plain(t.per_second_rate(rates, ["run", "service"]), 3)


@query
def gauge_levels(spark, sf):
    return plain(t.gauge_levels(src.samples(spark, sf), ["run", "service"], "mem_bytes", block_seconds=DAYS), 3)


@query
def counter_at_time(spark, sf):
    rows = src.samples(spark, sf)
    at = F.lit(9000.5)
    return plain(rows.groupBy(*SERIES).agg(t.value_at("cpu_usage_us", at).alias("value")), 3)


@query
def total_on_ticks(spark, sf):
    return plain(t.total_on_ticks(src.samples(spark, sf), ["run", "service"], "cpu_usage_us", block_seconds=DAYS), 0)


@query
def total_on_epochs(spark, sf):
    """The same sums on epoch seconds, where cancelling terms would show."""
    late = src.samples(spark, sf).withColumn("t", F.col("t") + F.lit(1.7e9))
    thousands = t.total_on_ticks(late, ["run", "service"], "cpu_usage_us", block_seconds=DAYS).withColumn("total", F.col("total") / 1000)
    return plain(thousands, 3)


@query
def time_reaching(spark, sf):
    reached = t.time_reaching(
        src.samples(spark, sf), SERIES, "cpu_usage_us", {"low": F.lit(50000.0), "high": F.lit(1e12)}, DAYS
    )
    return plain(reached, 6)


def _produced(spark, sf):
    consumed = src.lags(spark, sf).select("run", "t", F.col("produced").alias("total"))
    return consumed, consumed.groupBy("run").agg(F.max("total").alias("records"))


@query
def drain_summary(spark, sf):
    consumed, runs = _produced(spark, sf)
    return plain(t.drain_summary(consumed, runs), 6)


def _usage(spark, sf):
    rows = src.samples(spark, sf)
    spans = rows.groupBy("run").agg(
        (F.min("t") + 30.5).alias("start"), (F.max("t") - 30.25).alias("end"), F.count("*").alias("events")
    )
    return t.resource_usage(rows, spans, {"streams": 1.0, "kafka": 2.0})


@query
def resource_usage(spark, sf):
    return plain(_usage(spark, sf), 6)


def _probes(spark, sf):
    sends = src.probe_sends(spark, sf)
    seen = src.probe_sightings(spark, sf).drop("run")
    return t.probe_latencies(sends, seen, 12_000)


@query
def probe_latencies(spark, sf):
    return plain(_probes(spark, sf))


@query
def latency_summary(spark, sf):
    return plain(t.latency_summary(_probes(spark, sf), ["run"]), 6)


@query
def latency_cdf(spark, sf):
    return plain(t.latency_cdf(_probes(spark, sf), ["run"]), 9)


@query
def value_percentiles(spark, sf):
    return plain(t.percentiles(src.table(spark, sf, "lineitem"), "l_extendedprice", t.LATENCY_FRACTIONS, ["l_returnflag"]), 4)


@query
def lag_summary(spark, sf):
    return t.lag_summary(src.lags(spark, sf), ["run"])


@query
def measured_span(spark, sf):
    return plain(t.measured_span(src.lags(spark, sf), ["run"]))


@query
def group_lag(spark, sf):
    orders = src.table(spark, sf, "orders").withColumn("partition", (F.col("o_custkey") % 6).cast("int"))
    keys = [F.col("o_orderpriority").alias("run"), "partition"]
    ends = orders.groupBy(*keys).agg(F.count("*").alias("end_offset"))
    done = orders.where("o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'").groupBy(*keys).agg(F.count("*").alias("committed_offset"))
    return t.group_lag(ends, done, ["run"])


@query
def metric_summary(spark, sf):
    wide = src.samples(spark, sf).select(
        *SERIES,
        "t",
        F.col("cpu_usage_us").alias("jmx_append_ms_total"),
        (F.col("cpu_usage_us") / 8).alias("jmx_append_count_total"),
        F.when(F.col("t") % 2 == 0, F.col("mem_bytes")).alias("jmx_lag_max"),
    )
    return plain(t.metric_summary(t.unpivot_metrics(wide, ["run", "container"]), ["run", "container"]), 4)


@query
def container_rates(spark, sf):
    return plain(t.container_rates(src.samples(spark, sf), SERIES, {"cpu_usage_us": 1e-4}, DAYS), 6)


@query
def service_totals(spark, sf):
    rates = t.container_rates(src.samples(spark, sf), SERIES, {"cpu_usage_us": 1e-4}, DAYS)
    return plain(t.service_totals(rates.withColumnRenamed("cpu_usage_us_per_s", "cpu_pct_mean")), 4)


@query
def service_means(spark, sf):
    replicas = src.samples(spark, sf).select("run").distinct().withColumn("replicas", F.ascii(F.substring("run", 2, 1)) % 2)
    return plain(t.service_means(_usage(spark, sf), replicas), 6)


@query
def scaling_table(spark, sf):
    return plain(t.scaling_table(src.repeats(spark, sf)), 4)


@query
def load_runs(spark, sf):
    """Run summaries written one file per run, as a test harness leaves them, and read again."""
    out = work_dir(spark, "runs")
    files.write_runs(src.repeats(spark, sf), out)
    schema = "replicas INT, profile STRING, throughput DOUBLE, events BIGINT, max_speedup DOUBLE"
    return plain(files.read_runs(spark, out, schema), 4)


@query
def paced_speeds(spark, sf):
    return plain(t.paced_speeds(src.repeats(spark, sf)), 4)


@query
def moving_mean(spark, sf):
    series = src.lags(spark, sf).withColumn("lag", (F.col("produced") - F.col("committed")).cast("double"))
    return plain(t.smooth(series.select("run", "t", "lag"), ["run"], "t", "lag", 5), 6)


@query
def bucket_mean(spark, sf):
    series = src.lags(spark, sf).withColumn("lag", (F.col("produced") - F.col("committed")).cast("double"))
    return plain(t.bucketed(series.select("run", "t", "lag"), ["run"], "t", "lag", 24), 6)


def _run_documents(spark, sf):
    """Nested run summaries as the run tables read them."""
    runs = src.repeats(spark, sf)
    none = F.lit(None).cast("double")
    usage = F.struct(
        (F.col("throughput") / 100).alias("pct_of_limit"),
        (F.col("throughput") / F.col("events")).alias("cpu_us_per_event"),
        F.col("max_speedup").alias("mem_mb_max"),
        F.col("max_speedup").alias("mean_cores"),
    )
    month = F.element_at(F.split("run", "-"), -1).cast("int")
    kind = F.element_at(F.array(F.lit("capacity"), F.lit("latency"), F.lit("sustain")), month % 3 + 1)
    latency = F.struct(
        F.col("events").alias("count"),
        F.lit(0).cast("bigint").alias("timeouts"),
        (F.col("throughput") / 7).alias("p50"),
        (F.col("throughput") / 3).alias("p95"),
        F.col("throughput").alias("max"),
    )
    return runs.select(
        "run",
        kind.alias("kind"),
        "profile",
        F.lit("average").alias("scenario"),
        "replicas",
        F.lit(2.0).alias("speed"),
        F.lit("2021-11-10T15:00:00").alias("from"),
        F.lit("2021-11-10T18:00:00").alias("to"),
        "events",
        F.col("events").alias("records"),
        F.col("throughput").alias("throughput_eps"),
        F.col("throughput").alias("achieved_eps"),
        F.lit(10.0).alias("measured_seconds"),
        F.col("max_speedup").alias("max_speedup_from_partition_skew"),
        F.lit(0).cast("bigint").alias("final_lag"),
        none.alias("duplicate_fraction"),
        F.struct(F.col("events").alias("max"), F.lit(0).cast("bigint").alias("final")).alias("lag"),
        F.when(kind == "latency", latency).alias("latency_ms"),
        F.create_map(F.lit("streams"), usage, F.lit("kafka"), usage).alias("resources"),
    )


@query
def capacity_table(spark, sf):
    return plain(t.capacity_table(_run_documents(spark, sf)), 4)


@query
def paced_table(spark, sf):
    return plain(t.paced_table(_run_documents(spark, sf)), 4)


@query
def rate_latency_curve(spark, sf):
    return plain(t.rate_latency_curve(_run_documents(spark, sf), "profile"), 4)


@query
def exposition_lines(spark, sf):
    parsed = t.parse_exposition(src.metric_lines(spark, sf))
    return parsed.groupBy("scrape", "name", F.try_element_at("labels", F.lit("topic")).alias("topic")).agg(
        F.count("*").alias("lines"), F.sum("value").alias("value")
    )


@query
def metric_selection(spark, sf):
    parsed = t.parse_exposition(src.metric_lines(spark, sf))
    want = {"topic": None, "client_id": t.main_consumer}
    chosen = [
        t.select_metric(parsed, ["scrape"], "log_count", want, how).withColumn("how", F.lit(how)) for how in ("sum", "max")
    ]
    return chosen[0].unionByName(chosen[1])


@query
def histogram_millis(spark, sf):
    return t.histogram_millis(t.parse_exposition(src.metric_lines(spark, sf)), ["scrape"], "log", {"topic": None})


@query
def scrape_columns(spark, sf):
    specs = {
        "log_ms": ("histogram", "log", {"topic": None}),
        "log_count": ("sum", "log_count", {"topic": None, "client_id": t.main_consumer}),
        "get_max": ("max", "state_get_rate", {"topic": "t1"}),
    }
    return t.scrape_columns(t.parse_exposition(src.metric_lines(spark, sf)), ["scrape"], specs)


@query
def rate_time(spark, sf):
    return plain(t.rate_time(t.parse_exposition(src.metric_lines(spark, sf)), ["scrape"], "state", ["get"]), 9)


# -- streaming -----------------------------------------------------------------


def _tick_files(spark: SparkSession, sf: str, by: str, shuffled: bool = False) -> tuple[DataFrame, str]:
    """Ticks written as files and read back as a stream; returns the stream and its work folder."""
    out = work_dir(spark, "stream")
    stored = src.ticks(spark, sf, by, shuffled)
    stored.write.parquet(f"{out}/ticks")
    return spark.readStream.schema(stored.schema).parquet(f"{out}/ticks"), out


@query
def stream_points(spark, sf):
    ticks, out = _tick_files(spark, sf, "type")
    run = crossover.write_points(crossover.stream_points(ticks), out, f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return plain(spark.read.parquet(f"{out}/history").drop("batch_id", "day"), 6)


@query
def stream_exact_points(spark, sf):
    ticks, out = _tick_files(spark, sf, "type", shuffled=True)
    run = exact.write_exact_points(ticks, out, f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return plain(spark.read.parquet(f"{out}/history").drop("batch_id", "day"), 6)


@query
def stream_progress(spark, sf):
    """Rows read and rows dropped as late, from the progress of every micro-batch."""
    ticks, out = _tick_files(spark, sf, "type")
    log = metrics.ProgressLog(spark, f"{out}/progress", every=2)
    spark.streams.addListener(log)
    try:
        run = crossover.write_points(crossover.stream_points(ticks), out, f"{out}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
        log.ended.wait(60)
        rows = log.frame()
    finally:
        spark.streams.removeListener(log)
    return rows.agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


@query
def stream_counts(spark, sf):
    """Rows accepted, skipped and rejected by a stream in several micro-batches, from the progress table."""
    out = work_dir(spark, "counted")
    raw = src.raw_rows(spark, sf)
    raw.repartition(3).write.json(f"{out}/in")
    rows = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).json(f"{out}/in")
    log = metrics.ProgressLog(spark, f"{out}/progress", every=2)
    spark.streams.addListener(log)
    try:
        good = i.accepted(i.observed(i.classify(rows)))
        writer = good.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
        writer.start(path=f"{out}/rows", format="parquet").awaitTermination()
        log.ended.wait(60)
        found = log.frame()
    finally:
        spark.streams.removeListener(log)
    counts = found.agg(*[F.sum(s).alias(s) for s in (i.ACCEPTED, i.SKIPPED, i.REJECTED)])
    return counts.withColumn("stored", spark.read.parquet(f"{out}/rows").agg(F.count("*")).scalar())


@query
def stream_advisories(spark, sf):
    ticks, out = _tick_files(spark, sf, "type")
    run = crossover.write_points(crossover.stream_points(ticks), out, f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return plain(spark.read.parquet(f"{out}/advisories").drop("batch_id"), 6)


@query
def stream_exact_advisories(spark, sf):
    ticks, out = _tick_files(spark, sf, "type", shuffled=True)
    run = exact.write_exact_points(ticks, out, f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return plain(spark.read.parquet(f"{out}/advisories").drop("batch_id"), 6)


@query
def stream_registry(spark, sf):
    ticks, out = _tick_files(spark, sf, "user")
    run = crossover.write_registry(ticks, out, f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return plain(spark.read.parquet(f"{out}/symbols").drop("batch_id"))
