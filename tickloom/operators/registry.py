"""The symbol registry: every symbol once, as it first arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.hashing import partition_of
from tickloom.schemas import SEARCH_LIMIT


def symbol_registry(ticks: DataFrame) -> DataFrame:
    """symbol, security type ('' if absent) and event time of its first *arrival*.

    A first aggregation over (symbol, type) keeps fixed-width state only, so it
    stays hash-based on the ticks; the second one sees a row per symbol and type.
    """
    kinds = ticks.groupBy("symbol", "security_type").agg(
        F.min("arrival").alias("arrival"), F.min_by("event_ts", "arrival").alias("event_ts")
    )
    first = F.min_by(F.struct("security_type", "event_ts"), "arrival").alias("f")
    return kinds.groupBy("symbol").agg(first).select(
        "symbol", F.coalesce("f.security_type", F.lit("")).alias("security_type"), F.col("f.event_ts").alias("first_seen")
    )


def new_symbols(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows not registered before."""
    return found.join(registry.select("symbol"), "symbol", "left_anti")


def registry_records(registry: DataFrame) -> DataFrame:
    """Topic records: key = symbol, value = JSON with the first-seen time in milliseconds."""
    body = F.struct(
        "symbol",
        F.col("security_type").alias("securityType"),
        F.unix_millis("first_seen").cast("double").alias("firstSeen"),
    )
    return registry.select(F.col("symbol").alias("key"), F.to_json(body).alias("value"))


def latest_per_key(records: DataFrame, order: str) -> DataFrame:
    """The compacted view of a keyed topic: the last record of each key wins."""
    return records.groupBy("key").agg(F.max_by("value", order).alias("value"))


def symbol_list(records: DataFrame) -> DataFrame:
    """Distinct non-null keys of registry records, sorted."""
    return records.where(F.col("key").isNotNull()).select(F.col("key").alias("symbol")).distinct().orderBy("symbol")


def _matching(registry: DataFrame, needle: str) -> DataFrame:
    text = needle.strip().lower()
    return registry.where(F.contains(F.lower("symbol"), F.lit(text))) if text else registry


def symbol_search(registry: DataFrame, needle: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """The first ``limit`` symbols containing ``needle`` in any case, with the number of all matches."""
    found = _matching(registry, needle).select("symbol").distinct()
    return found.orderBy("symbol").limit(limit).withColumn("matches", found.agg(F.count("*")).scalar())


def with_topic_partition(ticks: DataFrame, partitions: int, symbols: DataFrame | None = None) -> DataFrame:
    """Add the topic partition of each symbol.

    The hash runs once per symbol, not per tick. ``symbols`` may be the stored
    registry: its measured size decides on a broadcast before any tick moves,
    and a symbol it lacks is hashed on the spot. Without it the symbols come
    from the ticks.
    """
    place = partition_of(F.col("symbol"), partitions)
    if symbols is None:
        return ticks.join(ticks.select("symbol").distinct().withColumn("partition", place), "symbol")
    known = symbols.select("symbol").distinct().withColumn("known", place)
    return ticks.join(known, "symbol", "left").withColumn("partition", F.coalesce("known", place)).drop("known")


def partition_skew(ticks: DataFrame, partitions: int) -> DataFrame:
    """Records per topic partition, the busiest one, and the speed-up the spread allows (total / busiest).

    Ticks are counted per symbol before anything is hashed; none of them is joined.
    """
    by_symbol = ticks.where(F.col("symbol").isNotNull()).groupBy("symbol").agg(F.count("*").alias("n"))
    counts = by_symbol.groupBy(partition_of(F.col("symbol"), partitions).alias("partition")).agg(F.sum("n").alias("records"))
    busiest, total = counts.agg(F.max("records")).scalar(), counts.agg(F.sum("records")).scalar()
    return counts.withColumns(
        {"busiest": busiest, "total": total, "max_speedup": total.cast("double") / busiest}
    )
