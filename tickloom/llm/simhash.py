"""Near duplicates by SimHash: fingerprints, exact links within a bit radius, connected components.

Equal fingerprints collapse first. Two distinct ones within `radius` bits agree in at least BLOCKS - radius of BLOCKS
bit ranges, so every pair meets under one of the keys made from so many ranges. A key with more than TILE fingerprints
is cut into tiles by population count; a pair of tiles whose counts differ by more than the radius is never formed.
Inside a task, tiles are compared exactly by exclusive-or and bit counts, and of the links found a spanning forest is
passed on, which has fewer rows than fingerprints compared. Components come from alternating stars, cut by stored tables.

Rows: a null or empty text, like one of spaces only, has fingerprint zero and links like any other; repeated rows get
equal results; a null doc_id never names a component unless no other id is there. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, stored, texts_of

SHINGLE, RADIUS, SEED = 3, 3, 42
BLOCKS = 5  # ten keys of about 26 bits
TILE = 8192  # fingerprints of one key that a task compares with each other
STRIP = 512  # rows of the arrays compared at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()  # bytes.lower() changes A-Z alone
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -shingle] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in blocks(batches):
            prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            marks = np.array([xxhash.xxh64_intdigest(t or b"", SEED) for t in texts], np.uint64).view(np.int64)
            yield batch_of(doc_id=pa.array(ids, pa.int64()), fp=pa.array(prints), mark=pa.array(marks))

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed 64-bit number) and mark (xxhash64 of the text)."""
    return texts_of(docs, id_col, text_col).mapInArrow(_fingerprints(shingle), "doc_id long, fp long, mark long")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component in the graph with links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not (label[label] == label).all():
            label = label[label]


def near(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that joins exactly the fingerprints connected by links of at most `radius` bits. prints: distinct."""
    ones = np.bitwise_count(prints)
    order = np.argsort(ones, kind="stable")
    prints, ones = prints[order], ones[order].astype(np.int64)
    left, right = [], []
    for i in range(0, len(prints), STRIP):
        a = prints[i : i + STRIP]
        most = ones[min(i + STRIP, len(ones)) - 1]
        for j in range(i, len(prints), STRIP):
            if ones[j] - most > radius:
                break
            b = prints[j : j + STRIP]
            x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
            x, y = x + i, y + j
            apart = x < y
            x, y = x[apart], y[apart]
            if len(x):
                own, back = np.unique(np.concatenate((x, y)), return_inverse=True)
                label = roots(len(own), back[: len(x)], back[len(x) :])
                joined = label != np.arange(len(own))
                left.append(own[joined])
                right.append(own[label[joined]])
    if not left:
        return prints[:0], prints[:0]
    label = roots(len(prints), np.concatenate(left), np.concatenate(right))
    joined = label != np.arange(len(prints))
    return prints[joined], prints[label[joined]]


def _links(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.empty((0, 2), np.int64), np.empty(0, np.int64)

        def found(values: np.ndarray) -> pa.RecordBatch:
            a, b = near(np.unique(values.view(np.uint64)), radius)
            a, b = a.view(np.int64), b.view(np.int64)
            return batch_of(u=pa.array(np.maximum(a, b)), v=pa.array(np.minimum(a, b)))

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "tiles")], axis=1)
            held_keys = np.concatenate((held_keys, keys))
            held = np.concatenate((held, batch.column("fp").to_numpy(zero_copy_only=False)))
            # whole keys together, a few thousand fingerprints at a time; the last key may go on in the next batch
            last = np.flatnonzero((held_keys[1:] != held_keys[:-1]).any(axis=1)) + 1
            at = 0
            while at < len(held) and len(last):
                ends = last[last > at]
                if not len(ends):
                    break
                wanted = np.searchsorted(ends, at + 2048)
                end = ends[min(wanted, len(ends) - 1)]
                yield found(held[at:end])
                at = end
            held_keys, held = held_keys[at:], held[at:]
        if len(held):
            yield found(held)

    return run


def _keys(radius: int, blocks_: int) -> F.Column:
    """All keys of fp as an array: the number of the combination, then its bit ranges."""
    width = [64 // blocks_ + (i < 64 % blocks_) for i in range(blocks_)]
    start = [sum(width[:i]) for i in range(blocks_)]
    part = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(start, width)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks_), blocks_ - radius)):
        key = F.lit(number).cast("long")
        for i in chosen:
            key = F.shiftleft(key, max(width)).bitwiseOR(part[i])
        keys.append(key)
    return F.array(*keys)


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE, blocks_: int = BLOCKS) -> DataFrame:
    """u > v: a forest per task over the distinct values of prints.fp, with the components of all links within the radius."""
    keyed = prints.select("fp").distinct().select("fp", F.explode(_keys(radius, blocks_)).alias("key"))
    ones = F.bit_count("fp").cast("int")
    crowded = keyed.groupBy("key", ones.alias("ones")).agg(F.count(F.lit(1)).alias("n"))
    crowded = crowded.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("most")).filter(F.col("n") > tile)
    crowded = crowded.select("key", F.ceil(F.col("most") / tile).cast("int").alias("cuts"))
    both = keyed.join(crowded, "key", "left")
    # a tile is (population count, cut); a fingerprint goes to each pair of tiles that holds its own and a near one
    own = ones.cast("long") * (1 << 20) + F.pmod(F.xxhash64("fp"), F.col("cuts"))
    near_ones = F.sequence(F.greatest(ones - radius, F.lit(0)), F.least(ones + radius, F.lit(64)))
    cuts = F.sequence(F.lit(0), F.col("cuts") - 1)
    others = F.flatten(F.transform(near_ones, lambda p: F.transform(cuts, lambda c: p.cast("long") * (1 << 20) + c)))
    pairs = F.transform(others, lambda o: F.least(own, o) * (1 << 27) + F.greatest(own, o))
    tiles = F.when(F.col("cuts").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pairs)
    groups = both.select("key", "fp", F.explode(tiles).alias("tiles"))
    return groups.repartition("key", "tiles").sortWithinPartitions("key", "tiles").mapInArrow(_links(radius), "u long, v long")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """member, root: each node of the links u > v with the smallest node it is connected to, the roots left out.

    Alternating large and small stars. Each round stores its links, a row per link at most, and ends when they stay.
    """
    edges = stored(edges.select("u", "v").distinct(), "links")
    state = _state(edges)
    while True:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u")
        small = small.filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(least.select("u", F.col("low").alias("v"))).distinct()
        edges, before = stored(small, "links"), state
        state = _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("member"), F.col("v").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of `docs`: doc_id, fp, mark, component_id."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    root = components(links(distinct, radius))
    member = distinct.join(root, distinct.fp == root.member, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    names = member.join(named, "root").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", "fp", "mark", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` whose id names their group, with their columns; a group without any id stays whole."""
    groups = near_groups(docs, id_col, text_col, shingle, radius)
    dropped = groups.filter("component_id is not null and not (doc_id <=> component_id)")
    dropped = dropped.select(F.col("doc_id").alias("dropped_id_"), F.col("mark").alias("dropped_mark_")).distinct()
    mark = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    same = docs[id_col].cast("long").eqNullSafe(dropped.dropped_id_) & (mark == dropped.dropped_mark_)
    return docs.join(dropped, same, "left_anti")
