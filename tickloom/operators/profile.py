"""Dataset profile: a ladder of rollups (second → minute → symbol) and the reports read from it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.frames import parsed_once
from tickloom.functions.text import blank_to_null, price_value
from tickloom.functions.times import LOCAL_FORMAT
from tickloom.operators.scan import numbered, quantiles, ranked
from tickloom.sources.tables import day_files, read_table, remove

# Report sizes, concentration ranks, percentiles and core hours.
TOP_SYMBOLS = 25
TOP_PEAKS = 20
RANKS = (1, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000)
SECOND_FRACTIONS = (0.5, 0.9, 0.99, 0.999, 1.0)
CORE_HOURS = (9, 17)
CORE_SECONDS = 9 * 60 * 60

# The positional columns the profile reads.
ID, TYPE, DATE, TIME, LAST, VOLUME, TRADING_TIME, TRADING_DATE = "c00", "c01", "c02", "c03", "c21", "c22", "c23", "c26"

MINUTE_TEXT = "yyyy-MM-dd'T'HH:mm"
SECOND_TEXT = "yyyy-MM-dd'T'HH:mm:ss"
_SUMS = ("events", "price_events", "volume")


def _strict_time(text: Column) -> Column:
    """Wall clock whose text carries a fraction; other text is NULL."""
    return F.when(text.rlike(r"\.\d{1,3}$"), F.try_to_timestamp(text, F.lit(LOCAL_FORMAT)))


def positional_facts(raw: DataFrame) -> DataFrame:
    """Positional text rows → symbol, security_type, second, is_price_event, volume.

    The profile has its own price test: the price text is not trimmed and event
    time needs a fraction. Rows without a system time (headers, notes) drop out.
    """
    trading = blank_to_null(F.col(TRADING_DATE)).isNotNull() & blank_to_null(F.col(TRADING_TIME)).isNotNull()
    chosen = F.when(trading, F.concat_ws(" ", F.trim(TRADING_DATE), F.trim(TRADING_TIME))).otherwise(
        F.concat_ws(" ", F.trim(DATE), F.trim(TIME))
    )
    named = blank_to_null(F.col(ID)).isNotNull() & blank_to_null(F.col(TYPE)).isNotNull()
    price_event = named & price_value(F.col(LAST)).isNotNull() & _strict_time(chosen).isNotNull()
    second = F.date_trunc("second", _strict_time(F.concat(F.col(DATE), F.lit(" "), F.col(TIME))))
    return parsed_once(
        raw,
        [],
        {
            "symbol": F.col(ID),
            "security_type": F.col(TYPE),
            "second": second,
            "is_price_event": F.coalesce(price_event, F.lit(False)),
            "volume": F.col(VOLUME).try_cast("double"),
        },
    ).where("second IS NOT NULL")


def symbol_seconds(facts: DataFrame) -> DataFrame:
    """Events, price events and traded volume per symbol and second; everything else derives from this.

    A smallest text cannot be kept in a hash aggregate, so the type is a key of a
    first one that takes all ticks, and only its result is aggregated by sorting.
    """
    traded = F.when(F.col("is_price_event") & (F.col("volume") > 0), F.col("volume"))
    by_type = facts.groupBy("symbol", "second", "security_type").agg(
        F.count("*").alias("events"), F.count_if("is_price_event").alias("price_events"), F.sum(traded).alias("volume")
    )
    return by_type.groupBy("symbol", "second").agg(
        F.min("security_type").alias("security_type"),
        F.sum("events").alias("events"),
        F.sum("price_events").alias("price_events"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS]


def second_totals(sym_sec: DataFrame) -> DataFrame:
    return sym_sec.groupBy("second").agg(*_sums())


def _symbol_minutes(sym_sec: DataFrame) -> DataFrame:
    return sym_sec.groupBy("symbol", F.date_trunc("minute", "second").alias("ts")).agg(
        F.min("security_type").alias("security_type"), *_sums()
    )


def symbol_minute(sym_sec: DataFrame) -> DataFrame:
    """Totals per symbol and minute; rows without a symbol are left out."""
    return _symbol_minutes(sym_sec.where("symbol IS NOT NULL"))


def minute_totals(sym_sec: DataFrame) -> DataFrame:
    """Totals per minute over all rows, with the number of distinct (non-null) symbols.

    Symbols are already distinct one level up, so counting them needs no second
    de-duplication.
    """
    return _symbol_minutes(sym_sec).groupBy("ts").agg(*_sums(), F.count("symbol").alias("active_symbols"))


def symbol_totals(sym_min: DataFrame) -> DataFrame:
    """Totals per symbol and its busiest minute by events and by price events (earliest on ties)."""

    def peak(column: str) -> Column:
        # Fixed-width ordering: the count first, then the earlier minute.
        order = F.col(column).cast("decimal(19,0)") * F.expr("10000000000BD") - F.unix_seconds("ts")
        return F.max_by("ts", order)

    return sym_min.groupBy("symbol").agg(
        F.min("security_type").alias("security_type"),
        *_sums(),
        peak("events").alias("peak_minute"),
        F.max("events").alias("peak_minute_events"),
        peak("price_events").alias("peak_price_minute"),
        F.max("price_events").alias("peak_minute_price_events"),
    )


def profile_totals(minutes: DataFrame, symbols: DataFrame) -> DataFrame:
    return minutes.agg(*_sums(), F.min("ts").alias("first_minute"), F.max("ts").alias("last_minute")).withColumn(
        "symbols", symbols.agg(F.count("*")).scalar()
    )


def by_day(minutes: DataFrame) -> DataFrame:
    return minutes.groupBy(F.to_date("ts").alias("day")).agg(*_sums())


def by_exchange(symbols: DataFrame) -> DataFrame:
    """Totals per venue (the symbol's part after its last dot) and security type."""
    venue = F.split_part("symbol", F.lit("."), F.lit(-1)).alias("exchange")
    return symbols.groupBy(venue, "security_type").agg(
        F.sum("events").alias("events"),
        F.sum("price_events").alias("price_events"),
        F.count("*").alias("symbols"),
        F.count_if(F.col("price_events") > 0).alias("price_symbols"),
    )


def symbol_stats(symbols: DataFrame) -> DataFrame:
    """Distribution of price events over symbols, in one row; the quantiles cover active symbols only."""
    active = F.col("price_events") > 0
    placed = quantiles(
        symbols.where(active), "price_events", {"median_price_events": 0.5, "p90_price_events": 0.9, "p99_price_events": 0.99}
    )
    stats = symbols.agg(
        F.count("*").alias("symbols"),
        F.count_if(active).alias("active_symbols"),
        F.count_if(F.col("price_events") == 0).alias("zero_symbols"),
        F.sum("price_events").alias("total_price_events"),
        F.avg(F.when(active, F.col("price_events"))).alias("mean_price_events"),
        F.max("price_events").alias("max_price_events"),
    )
    row = placed.select(F.struct(*placed.columns)).scalar()
    return stats.withColumn("row", row).select(*stats.columns, "row.*")


def symbol_bins(symbols: DataFrame) -> DataFrame:
    """Active symbols by the power of ten of their price events, with their shares."""
    active = symbols.where("price_events > 0")
    magnitude = F.floor(F.log10("price_events")).cast("int").alias("magnitude")
    bins = active.groupBy(magnitude).agg(F.count("*").alias("symbols"), F.sum("price_events").alias("price_events"))
    all_symbols, all_events = active.agg(F.count("*")).scalar(), active.agg(F.sum("price_events")).scalar()
    low = F.pow(F.lit(10.0), "magnitude").cast("bigint").cast("string")
    high = (F.pow(F.lit(10.0), F.col("magnitude") + 1) - 1).cast("bigint").cast("string")
    return bins.select(
        "magnitude",
        F.concat_ws("-", low, high).alias("event_range"),
        "symbols",
        (F.lit(100.0) * F.col("symbols") / all_symbols).alias("symbol_share_pct"),
        "price_events",
        (F.lit(100.0) * F.col("price_events") / all_events).alias("event_share_pct"),
    )


def minute_series(minutes: DataFrame) -> DataFrame:
    return minutes.select(F.date_format("ts", MINUTE_TEXT).alias("t"), *_SUMS, "active_symbols").orderBy("t")


def _weekday(ts: str) -> Column:
    return F.weekday(ts) <= 4


def minute_of_day(minutes: DataFrame) -> DataFrame:
    """Average and largest minute by time of day, Monday to Friday."""
    return (
        minutes.where(_weekday("ts"))
        .groupBy(F.date_format("ts", "HH:mm").alias("t"))
        .agg(
            F.avg("events").alias("mean_events"),
            F.avg("price_events").alias("mean_price_events"),
            F.max("events").alias("max_events"),
            F.max("price_events").alias("max_price_events"),
        )
    )


def peaks(totals: DataFrame, time: str, by: str, n: int = TOP_PEAKS) -> DataFrame:
    """The ``n`` busiest minutes or seconds by ``by``, earliest first on ties (a top-n report)."""
    return totals.orderBy(F.col(by).desc(), F.col(time)).limit(n)


def second_percentiles(seconds: DataFrame, fractions=SECOND_FRACTIONS) -> DataFrame:
    """Per-second percentiles in core hours on weekdays and the mean price events per core second.

    Equal counts are merged before the percentile, whose state is then one entry
    per distinct count.
    """
    core = seconds.where(_weekday("second") & F.hour("second").between(*CORE_HOURS))

    def spread(column: str) -> Column:
        counts = core.groupBy(column).agg(F.count("*").alias("n"))
        return counts.agg(F.percentile(column, list(fractions), F.col("n"))).scalar()

    mean = F.sum("price_events").cast("double") / (F.count_distinct(F.to_date("second")) * CORE_SECONDS)
    return core.agg(mean.alias("mean_price_events")).withColumns(
        {"events": spread("events"), "price_events": spread("price_events")}
    )


def top_symbols(symbols: DataFrame, by: str, n: int = TOP_SYMBOLS) -> DataFrame:
    return symbols.orderBy(F.col(by).desc(), "symbol").limit(n)


def tracked_symbols(symbols: DataFrame, n: int = TOP_SYMBOLS) -> DataFrame:
    """Symbols in either top list: at most ``2n`` rows."""
    lists = [top_symbols(symbols, by, n).select("symbol") for by in ("events", "price_events")]
    return lists[0].union(lists[1]).distinct()


def tracked_series(sym_min: DataFrame, tracked: DataFrame, step: str = "15 minutes") -> DataFrame:
    """Events and price events of tracked symbols per step (``tracked`` is usually a top list)."""
    return (
        sym_min.join(tracked, "symbol", "left_semi")
        .groupBy("symbol", F.window("ts", step).start.alias("t"))
        .agg(F.sum("events").alias("events"), F.sum("price_events").alias("price_events"))
    )


def concentration(symbols: DataFrame, ranks=RANKS) -> DataFrame:
    """Share of events (and of price events) the first k symbols hold, for each k in ``ranks``."""

    def share(column: str) -> DataFrame:
        total = symbols.agg(F.sum(column)).scalar()
        placed = ranked(symbols.select("symbol", column), column, "symbol", {"upto": column})
        return placed.where(F.col("rank").isin(*ranks)).select("rank", (F.col("upto").cast("double") / total).alias("share"))

    nothing = F.lit(None).cast("double")
    by_events = share("events").select("rank", F.col("share").alias("events_share"), nothing.alias("price_share"))
    by_price = share("price_events").select("rank", nothing.alias("events_share"), F.col("share").alias("price_share"))
    return by_events.unionByName(by_price)


def price_ranking(symbols: DataFrame) -> DataFrame:
    """Symbols with price events by rank, with own and cumulative share."""
    active = symbols.where("price_events > 0").select("symbol", "security_type", "price_events")
    total = active.agg(F.sum("price_events")).scalar()
    return ranked(active, "price_events", "symbol", {"upto": "price_events"}, rank="price_rank").select(
        "price_rank",
        "symbol",
        "security_type",
        "price_events",
        (F.col("price_events").cast("double") / total).alias("event_share"),
        (F.col("upto").cast("double") / total).alias("cumulative_event_share"),
    )


def anchor(minutes: DataFrame) -> DataFrame:
    """Midnight of the first day."""
    return minutes.agg(F.date_trunc("day", F.min("ts")).alias("start"))


def dense(series: DataFrame, keys: list[str], start: Column, step: str, n: int, time: str = "t") -> DataFrame:
    """A regular grid of ``n`` steps per key with zeros where the series is silent.

    ``start`` is a literal or a scalar subquery. Values outside the grid are
    dropped, values in the same step added.
    """
    values = [c for c in series.columns if c not in (*keys, time)]
    width = F.expr(f"INTERVAL {step}")
    last = start + width * F.lit(n - 1)
    origin = F.unix_micros(start)
    index = F.floor((F.unix_micros(time) - origin) / (F.unix_micros(start + width) - origin))
    placed = (
        series.withColumn("i", index.cast("int"))
        .where(F.col("i").between(0, n - 1))
        .groupBy(*keys, "i")
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    owners = series.select(*keys).distinct()
    grid = owners.select(*keys, F.posexplode(F.sequence(start, last, width)).alias("i", time))
    joined = grid.join(placed, [*keys, "i"], "left")
    return joined.select(*keys, "i", time, *[F.coalesce(v, F.lit(0)).alias(v) for v in values])


def tracked_records(symbols: DataFrame, sym_min: DataFrame, start: Column, steps: int, step: str = "15 minutes") -> DataFrame:
    """Per tracked symbol: totals, peaks and its two dense series as arrays of ``steps`` values."""
    tracked = tracked_symbols(symbols)
    grid = dense(tracked_series(sym_min, tracked, step), ["symbol"], start, step, steps)
    series = grid.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("i", "events", "price_events"))).alias("s")
    )
    wanted = symbols.join(tracked, "symbol", "left_semi")
    return wanted.join(series, "symbol").select(
        *symbols.columns,
        F.transform("s", lambda x: x["events"]).alias("events_series"),
        F.transform("s", lambda x: x["price_events"]).alias("price_series"),
    )


# -- distinct symbols that can be added up -------------------------------------


def symbol_numbers(rows: DataFrame) -> DataFrame:
    """Every symbol of the rows with a number of its own, counted from 0 in order of the symbols."""
    return numbered(rows.where("symbol IS NOT NULL").select("symbol").distinct(), "symbol", "number")


def day_bitmaps(sym_min: DataFrame, numbers: DataFrame) -> DataFrame:
    """The symbols of each day as bitmaps: day, bucket, bits. A bucket holds 32,768 symbols in 4 KB."""
    seen = sym_min.select(F.to_date("ts").alias("day"), "symbol").distinct().join(numbers, "symbol")
    by_bucket = seen.groupBy("day", F.bitmap_bucket_number("number").alias("bucket"))
    return by_bucket.agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def distinct_in_spans(bitmaps: DataFrame, spans: DataFrame) -> DataFrame:
    """Different symbols in each span of days, ``first`` to ``last``: bitmaps are merged, no tick or rollup is read."""
    days = spans.distinct().select("first", "last", F.explode(F.sequence("first", "last")).alias("day"))
    merged = days.join(bitmaps, "day").groupBy("first", "last", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("first", "last").agg(F.sum(F.bitmap_count("bits")).alias("symbols"))


# -- rollups of ticks that grow --------------------------------------------------


def facts_of_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks as profile facts; every tick is a price event, its price the traded volume."""
    return ticks.select(
        "symbol", "security_type", F.date_trunc("second", "event_ts").alias("second"),
        F.lit(True).alias("is_price_event"), F.col("price").alias("volume"),
    )


def refresh_seconds(spark: SparkSession, ticks: str, out: str, facts: Callable[[DataFrame], DataFrame]) -> list[date]:
    """Bring the stored symbol-second rollup up to date with stored ticks; returns the days that were collapsed again.

    A day's fingerprint is the names, sizes and times of its files, so only a listing is read to see what has changed.
    Fingerprints are stored last: a run that was cut short collapses its days again.
    """
    now = {r.day: r.fingerprint for r in day_files(spark, ticks).collect()}  # a row per day
    known = {r.day: r.fingerprint for r in read_table(spark, f"{out}/fingerprints", "day DATE, fingerprint BIGINT").collect()}
    changed = sorted(d for d in now if known.get(d) != now[d])
    if changed:
        rows = spark.read.parquet(ticks).where(F.col("day").isin(changed)).drop("day")
        seconds = symbol_seconds(facts(rows)).withColumn("day", F.to_date("second")).hint("rebalance", "day")
        seconds.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{out}/symbol_seconds")
    for day in known.keys() - now.keys():
        remove(spark, f"{out}/symbol_seconds/day={day}")
    if now != known:
        rows = spark.createDataFrame(sorted(now.items()), "day DATE, fingerprint BIGINT")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{out}/fingerprints")
    return changed


def refreshed_seconds(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/symbol_seconds").drop("day")


ROLLUPS = ("second_totals", "symbol_minute", "minute_totals")


def write_rollups(facts: DataFrame, out: str) -> None:
    """Collapse once, store, and write the three rollups range-partitioned and sorted by their keys."""
    spark = facts.sparkSession
    symbol_seconds(facts).write.mode("overwrite").parquet(f"{out}/symbol_seconds")
    base = spark.read.parquet(f"{out}/symbol_seconds")
    plans = {
        "second_totals": (second_totals(base), ["second"]),
        "symbol_minute": (symbol_minute(base), ["symbol", "ts"]),
        "minute_totals": (minute_totals(base), ["ts"]),
    }
    for name, (frame, order) in plans.items():
        frame.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{out}/{name}")


def read_rollups(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The stored rollups, for summaries without another pass over the ticks."""
    return {name: spark.read.parquet(f"{out}/{name}") for name in ROLLUPS}


def summary(rollups: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every report of the profile by name, from the three rollups."""
    seconds, sym_min, minutes = (rollups[name] for name in ROLLUPS)
    symbols = symbol_totals(sym_min)
    return {
        "totals": profile_totals(minutes, symbols),
        "by_day": by_day(minutes),
        "by_exchange": by_exchange(symbols),
        "price_symbol_stats": symbol_stats(symbols),
        "price_symbol_bins": symbol_bins(symbols),
        "minute_series": minute_series(minutes),
        "minute_of_day": minute_of_day(minutes),
        "peak_minutes": peaks(minutes, "ts", "events"),
        "peak_price_minutes": peaks(minutes, "ts", "price_events"),
        "peak_seconds": peaks(seconds, "second", "events"),
        "peak_price_seconds": peaks(seconds, "second", "price_events"),
        "second_percentiles": second_percentiles(seconds),
        "top_by_events": top_symbols(symbols, "events"),
        "top_by_price": top_symbols(symbols, "price_events"),
        "concentration": concentration(symbols),
        "symbol_series": tracked_series(sym_min, tracked_symbols(symbols)),
    }


def write_summary(rollups: dict[str, DataFrame], out: str) -> None:
    """Reports as JSON folders, and the price ranking as CSV with a header, in rank order."""
    for name, frame in summary(rollups).items():
        frame.write.mode("overwrite").json(f"{out}/summary/{name}")
    ranking = price_ranking(symbol_totals(rollups["symbol_minute"]))
    ranking.orderBy("price_rank").write.mode("overwrite").option("header", True).csv(f"{out}/price_events_by_symbol")
