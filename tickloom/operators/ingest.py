"""Row validation: raw text rows → events, skipped rows and rejects with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.functions.frames import parsed_once
from tickloom.functions.text import blank_to_null, price_value
from tickloom.functions.times import date_text, event_instant, iso_local, local_to_instant, parse_local
from tickloom.schemas import CSV_FIELDS, EVENT_JSON_DDL, MARKET_ZONE

ACCEPTED, SKIPPED, REJECTED = "accepted", "skipped", "rejected"


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower-cased, trimmed column names (a byte-order mark before the first one is dropped)."""
    return df.toDF(*[name.lstrip("﻿").strip().lower() for name in df.columns])


def _field(df: DataFrame, name: str) -> Column:
    return blank_to_null(F.col(f"`{name}`")) if name in df.columns else F.lit(None).cast("string")


def classify(raw: DataFrame, zone: str = MARKET_ZONE) -> DataFrame:
    """Add ``status``, ``reason`` and the event columns to rows with normalised headers.

    The first failing rule names the reason: blank price (skipped), blank id,
    blank type, bad price, missing date or time, bad date, bad timestamp. Event
    time is trading date and time when both are present, else date and time.
    """
    field = {name: _field(raw, name) for name in CSV_FIELDS}
    trading = field["trading date"].isNotNull() & field["trading time"].isNotNull()
    texts = raw.withColumns(
        {
            "__id": field["id"],
            "__type": field["sectype"],
            "__last": field["last"],
            "__date": F.when(trading, field["trading date"]).otherwise(field["date"]),
            "__time": F.when(trading, field["trading time"]).otherwise(field["time"]),
        }
    )
    last, date, time = F.col("__last"), F.col("__date"), F.col("__time")
    # Parsing is skipped for the many rows that carry no price.
    parsed = texts.withColumns(
        {
            "__price": F.when(last.isNotNull(), price_value(last)),
            "__local": F.when(last.isNotNull() & date.isNotNull() & time.isNotNull(), parse_local(date, time)),
        }
    )
    local = F.col("__local")
    reason = (
        F.when(last.isNull(), F.lit("non-price event: missing last"))
        .when(F.col("__id").isNull(), F.lit("missing required field: id"))
        .when(F.col("__type").isNull(), F.lit("missing required field: sectype"))
        .when(F.col("__price").isNull(), F.concat(F.lit("invalid price: "), last))
        .when(date.isNull(), F.lit("missing required field: date"))
        .when(time.isNull(), F.lit("missing required field: time"))
        .when(local.isNull() & date_text(date).isNull(), F.concat(F.lit("invalid date: "), date))
        .when(local.isNull(), F.concat(F.lit("invalid timestamp: "), date, F.lit(" "), time))
    )
    status = (
        F.when(last.isNull(), F.lit(SKIPPED))
        .when(F.col("reason").isNull(), F.lit(ACCEPTED))
        .otherwise(F.lit(REJECTED))
    )
    kept = [c for c in raw.columns if c not in CSV_FIELDS]
    return parsed_once(
        parsed.withColumn("reason", reason),
        kept,
        {
            "status": status,
            "reason": F.col("reason"),
            "symbol": F.col("__id"),
            "security_type": F.col("__type"),
            "price": F.col("__price"),
            "local_ts": local,
            "event_ts": local_to_instant(local, zone),
        },
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("status") == ACCEPTED).drop("status", "reason")


def quarantine(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("status") == REJECTED)


def status_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("status", "reason").agg(F.count("*").alias("rows"))


def first_rejects(classified: DataFrame, order: str, n: int = 10) -> DataFrame:
    """The first ``n`` rejected rows in arrival order (a report, hence the limit)."""
    return quarantine(classified).orderBy(order).limit(n)


def observe_counts(classified: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Count accepted, skipped and rejected rows while another action reads the frame."""
    observation = Observation(name)
    counts = [F.count_if(F.col("status") == s).alias(s) for s in (ACCEPTED, SKIPPED, REJECTED)]
    return classified.observe(observation, *counts), observation


def observed(classified: DataFrame, name: str = "ingest") -> DataFrame:
    """The streaming form: the counts of every micro-batch are in its progress under ``name``, from the pass that writes it."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in (ACCEPTED, SKIPPED, REJECTED)]
    return classified.observe(name, *counts)


def event_json(events: DataFrame) -> DataFrame:
    """Topic records: key = symbol, value = the event as JSON (needs ``local_ts``)."""
    body = F.struct(
        "symbol",
        F.col("security_type").alias("securityType"),
        "price",
        iso_local(F.col("local_ts")).alias("timestamp"),
    )
    return events.select(F.col("symbol").alias("key"), F.to_json(body).alias("value"))


def parse_event_json(df: DataFrame, value: str = "value", zone: str = MARKET_ZONE, typed: bool = True) -> DataFrame:
    """JSON text → event columns with ``status`` and ``reason``; blank lines are skipped.

    Without ``typed`` an event needs no security type; an absent one is ''.
    """
    text = F.col(value).cast("string")
    body = F.from_json(text, EVENT_JSON_DDL, {"mode": "PERMISSIVE"})
    rows = df.withColumn("__e", body).withColumn("event_ts", event_instant(F.col("__e.timestamp"), zone))
    kind = F.col("__e.securityType") if typed else F.coalesce("__e.securityType", F.lit(""))
    whole = (
        F.col("__e.symbol").isNotNull()
        & kind.isNotNull()
        & F.col("__e.price").isNotNull()
        & F.col("event_ts").isNotNull()
    )
    status = (
        F.when(blank_to_null(text).isNull(), F.lit(SKIPPED)).when(whole, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED))
    )
    return parsed_once(
        rows,
        [c for c in df.columns if c != "event_ts"],
        {
            "status": status,
            "reason": F.when(status == REJECTED, F.lit("unparseable event")),
            "symbol": F.col("__e.symbol"),
            "security_type": kind,
            "price": F.col("__e.price"),
            "event_ts": F.col("event_ts"),
        },
    )


def symbol_of(value: Column) -> Column:
    """Only the symbol of a JSON event."""
    return F.get_json_object(value.cast("string"), "$.symbol")
