"""The given tables seen as ticks, raw feed rows, profile facts, samples, lags, probes and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.scan import BLOCK_ROWS, running
from tickloom.session import use_utc

# How far the shuffled arrival order may move an event.
SHIFT = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its zone-less timestamps as instants (session zone UTC)."""
    use_utc(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Instants as zone-less timestamps, and doubles rounded to ``digits``, for comparison with SQL."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if digits is not None and isinstance(field.dataType, T.DoubleType):
            return F.round(column, digits).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


def _moved() -> Column:
    return F.pmod(F.col("event_id") * 7919, F.lit(SHIFT))


def ticks(spark: SparkSession, sf_dir: str, by: str = "type", shuffled: bool = False) -> DataFrame:
    """``events`` as ticks. ``by``: one long series per event type, or one per user and type.

    ``shuffled`` moves arrivals by up to six places, which makes events late.
    """
    events = table(spark, sf_dir, "events").where("value > 0")
    arrival = (F.col("event_id") + _moved()) * 8 + 7 - _moved() if shuffled else F.col("event_id")
    if by == "type":
        symbol, partition = F.col("event_type"), F.ascii("event_type") % 6
    else:
        symbol = F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("."), F.col("event_type"))
        partition = F.pmod(F.col("user_id"), F.lit(6)).cast("int")
    return events.select(
        symbol.alias("symbol"),
        F.when(F.col("user_id") % 10 == 0, "I").otherwise("E").alias("security_type"),
        F.col("value").alias("price"),
        F.col("ts").alias("event_ts"),
        arrival.alias("arrival"),
        partition.cast("int").alias("partition"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as feed rows in text, a known part of them damaged."""
    e = F.col("event_id")
    hit = lambda n, text, other: F.when(e % n == 0, F.lit(text)).otherwise(other)
    value = F.col("value").cast("decimal(18,2)").cast("string")
    last = hit(11, " ", hit(13, "not-a-price", hit(17, "0", F.concat(F.lit(" "), value))))
    day, clock = F.date_format("ts", "dd-MM-yyyy"), F.date_format("ts", "HH:mm:ss.SSS")
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        hit(19, "", F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("."), F.col("event_type"))).alias("id"),
        hit(23, "  ", F.when(F.col("user_id") % 10 == 0, "I").otherwise("E")).alias("sectype"),
        last.alias("last"),
        hit(29, "32-01-2024", day).alias("date"),
        hit(31, "25:61:00", clock).alias("time"),
        day.alias("trading date"),
        hit(5, "", clock).alias("trading time"),
    )


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as topic records of six partitions with offsets of their own; some lack the type, some are broken."""
    e = F.col("event_id")
    body = F.struct(
        F.col("event_type").alias("symbol"),
        F.when(e % 7 != 0, F.when(F.col("user_id") % 10 == 0, "I").otherwise("E")).alias("securityType"),
        F.when(e % 17 != 0, F.col("value")).alias("price"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
    )
    partition = F.pmod("user_id", F.lit(6)).cast("int")
    events = table(spark, sf_dir, "events").where("value > 0").withColumn("partition", partition).withColumn("one", F.lit(1))
    # a topic partition may hold any number of records: their places come from counts per block
    rows = running(events, keys=["partition"], order="event_id", block=F.expr(f"event_id div {BLOCK_ROWS}"), values={"before": ("one", "sum")})
    offset = F.coalesce("before", F.lit(0))
    value = F.when(e % 29 == 0, F.lit(" ")).when(e % 13 == 0, F.lit('{"symbol":')).otherwise(F.to_json(body))
    return rows.select("partition", offset.cast("bigint").alias("offset"), value.alias("value"))


def filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as rows of daily files: source_file, block_start (a split per three hours), row_id."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("day-"), F.date_format("ts", "dd"), F.lit(".csv")).alias("source_file"),
        F.floor(F.hour("ts") / 3).cast("bigint").alias("block_start"),
        F.col("event_id").alias("row_id"),
        F.col("ts").alias("event_ts"),
        F.col("value").alias("price"),
        F.when(F.col("event_id") % 9 != 0, F.date_format("ts", "dd-MM-yyyy")).alias("date"),
        F.when(F.col("user_id") % 4 == 0, F.lit("00:00:00.000")).otherwise(F.date_format("ts", "HH:mm:ss.SSS")).alias("time"),
        day.alias("day"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as profile facts; rows of user 7 carry no symbol."""
    symbol = F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("."), F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") != 7, symbol).alias("symbol"),
        F.when(F.col("user_id") % 10 == 0, "I").otherwise("E").alias("security_type"),
        F.date_trunc("second", "ts").alias("second"),
        (F.col("event_id") % 11 != 0).alias("is_price_event"),
        (F.col("value") - 20).alias("volume"),
    )


def day_number(ts: str) -> Column:
    return F.unix_date(F.to_date(ts)).cast("double")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as telemetry: per supplier and ship day a growing counter and a gauge, time in days."""
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", day_number("l_shipdate").alias("t"))
        .agg(F.sum("l_quantity").alias("used"), F.max("l_extendedprice").alias("gauge"))
    )
    # A row per day and supplier: the calendar bounds each window.
    so_far = Window.partitionBy("l_suppkey").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    counted = daily.withColumn("total", F.sum("used").over(so_far))
    service = F.element_at(F.array(F.lit("streams"), F.lit("kafka"), F.lit("producer")), (F.col("l_suppkey") % 3 + 1).cast("int"))
    return counted.select(
        F.concat(F.lit("r"), F.floor(F.col("l_suppkey") / 3) % 4).alias("run"),
        service.alias("service"),
        F.concat(F.lit("c"), F.col("l_suppkey")).alias("container"),
        "t",
        (F.col("total") * 997.31372911).alias("cpu_usage_us"),
        F.round(F.col("gauge") * 1024).alias("mem_bytes"),
    )


# Days per block when sample times are day numbers.
DAYS = 120


def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as lag samples: per priority and day the orders placed and the orders finished so far."""
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("run"), day_number("o_orderdate").alias("t"))
        .agg(F.count("*").alias("p"), F.count_if(F.col("o_orderstatus") == "F").alias("c"))
    )
    so_far = Window.partitionBy("run").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("run", "t", F.sum("p").over(so_far).alias("produced"), F.sum("c").over(so_far).alias("committed"))


def probe_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as probes: one per user and five-minute window, sent with its first event."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("run"),
            F.concat(F.col("user_id").cast("string"), F.lit("."), F.col("event_type")).alias("symbol"),
            F.window("ts", "5 minutes").start.alias("window_start"),
        )
        .agg(F.min(F.unix_millis("ts")).alias("t0_ms"))
    )


def probe_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each point was seen: its event time plus 100 ms per unit of value; points above 150 never are."""
    return (
        table(spark, sf_dir, "events")
        .where("value <= 150")
        .select(
            F.col("event_type").alias("run"),
            F.concat(F.col("user_id").cast("string"), F.lit("."), F.col("event_type")).alias("symbol"),
            F.window("ts", "5 minutes").start.alias("window_start"),
            (F.unix_millis("ts") + F.round(F.col("value") * 100).cast("bigint")).alias("t1_ms"),
        )
    )


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as repeated capacity runs: one per year and month of order, 1-6 replicas."""
    month = F.month("o_orderdate")
    runs = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("y"), month.alias("m"))
        .agg(F.sum("o_totalprice").alias("price"), F.count("*").alias("n"), F.count_if(F.col("o_custkey") % 6 == 0).alias("hot"))
    )
    return runs.select(
        F.concat(F.lit("run-"), F.col("y"), F.lit("-"), F.col("m")).alias("run"),
        (F.col("m") % 6 + 1).cast("int").alias("replicas"),
        F.when(F.col("y") % 2 == 0, "tuned").otherwise("shipped").alias("profile"),
        (F.col("price") / 997.31).alias("throughput"),
        F.col("n").alias("events"),
        F.try_divide(F.col("n").cast("double"), F.col("hot")).alias("max_speedup"),
    )


def metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as metric exposition text: one scrape per ship mode flag, several label shapes, notes and NaN."""
    item = table(spark, sf_dir, "lineitem")
    labels = F.concat(
        F.lit('client_id="s'),
        F.col("l_suppkey"),
        F.when(F.col("l_linenumber") % 2 == 0, "-restore-consumer").otherwise("-consumer"),
        F.when((F.col("l_linenumber") == 3) & (F.col("l_orderkey") % 2 == 0), '",topic="old').otherwise(""),
        F.when(F.col("l_linenumber") == 3, F.concat(F.lit('",topic="t'), F.col("l_suppkey") % 5)).otherwise(""),
        F.lit('"'),
    )
    name = F.element_at(
        F.array(*[F.lit(n) for n in ("state_get_rate", "state_get_latency_avg", "log_mean", "log_count")]),
        (F.col("l_orderkey") % 4 + 1).cast("int"),
    )
    number = F.when(F.col("l_quantity") == 13, F.lit("NaN")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    line = F.when(F.col("l_quantity") == 7, F.concat(F.lit("# HELP "), name)).otherwise(
        F.concat(name, F.lit("{"), labels, F.lit("} "), number)
    )
    return item.select(F.col("l_returnflag").alias("scrape"), line.alias("value"))
