"""The topic partition of a key: MurmurHash2 as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier and seed of the topic partitioner's MurmurHash2 (32 bit).
_MULTIPLIER = 0x5BD1E995
_SEED = 0x9747B28C
_WORD = 0xFFFFFFFF


def _times(value: Column) -> Column:
    # value < 2^32 and the multiplier < 2^31, so the product fits a BIGINT.
    return (value * F.lit(_MULTIPLIER)).bitwiseAND(F.lit(_WORD))


def _fold(value: Column, bits: int) -> Column:
    return value.bitwiseXOR(F.shiftright(value, bits))


def partition_of(key: Column, partitions: int) -> Column:
    """0-based partition of a text key, JVM-side; apply it to a symbol dimension, not to every tick."""
    raw = F.encode(key, "UTF-8")
    size = F.octet_length(raw)
    at = lambda i: F.conv(F.hex(F.substring(raw, i, 1)), 16, 10).cast("bigint")
    octets = F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), at)
    octet = lambda i: F.coalesce(F.get(octets, i), F.lit(0).cast("bigint"))
    whole = F.floor(size / 4).cast("int")

    def word(i: Column) -> Column:
        return sum((F.shiftleft(octet(i * 4 + n), 8 * n) for n in range(1, 4)), octet(i * 4))

    start = F.lit(_SEED).cast("bigint").bitwiseXOR(size.cast("bigint"))
    indexes = F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(F.array().cast("array<int>"))
    body = F.aggregate(
        indexes, start, lambda acc, i: _times(acc).bitwiseXOR(_times(_fold(_times(word(i)), 24)))
    )
    rest = word(whole)  # bytes past the end read as 0
    tail = F.when(size % 4 > 0, _times(body.bitwiseXOR(rest))).otherwise(body)
    digest = _fold(_times(_fold(tail, 13)), 15)
    return (digest.bitwiseAND(F.lit(0x7FFFFFFF)) % partitions).cast("int")
