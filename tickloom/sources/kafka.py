"""Topic sources and sinks. They need Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.ingest import parse_event_json
from tickloom.schemas import MARKET_ZONE
from tickloom.session import check_utc

FORMAT = "kafka"


def read_records(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic as a streaming frame of key, value, partition, offset, timestamp."""
    reader = spark.readStream.format(FORMAT).option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", "earliest").options(**options).load()


def read_snapshot(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Everything a topic holds now, from the earliest to the latest offset, as a batch frame."""
    reader = spark.read.format(FORMAT).option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    bounds = {"startingOffsets": "earliest", "endingOffsets": "latest"}
    return reader.options(**bounds, **options).load().withColumn("key", F.col("key").cast("string"))


def decode_ticks(records: DataFrame, zone: str = MARKET_ZONE) -> DataFrame:
    """Topic records → ticks with ``status`` and ``reason``; keep the accepted ones and quarantine the rejected.

    Arrival is (offset, partition): offsets repeat over partitions, and an arrival
    is unique. The clock that decides lateness is the partition's. An event needs
    no security type.
    """
    check_utc(records.sparkSession)
    arrival = F.struct("offset", "partition").alias("arrival")
    return parse_event_json(records.select("value", "partition", arrival), zone=zone, typed=False)


def write_records(records: DataFrame, servers: str, topic: str, checkpoint: str | None = None) -> DataStreamWriter | None:
    """Publish (key, value) records, acknowledged by all replicas; a streaming frame gives its writer."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    chosen = records.select("key", "value")
    if records.isStreaming:
        return chosen.writeStream.format(FORMAT).options(**options).option("checkpointLocation", checkpoint)
    chosen.write.format(FORMAT).options(**options).save()
    return None
