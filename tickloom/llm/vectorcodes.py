"""Product codes of vectors: exact k-means per part, with norm-of-sum bounds.

Vectors become integers and are cut into equal parts; every part position has a codebook of entries. Each round assigns all
parts to their nearest entries and moves the entries to the floored means of their parts. The codebooks of all rounds are
kept. A part holds, for each group of neighbouring entries, a lower bound of its distance to all of them but the one it is
assigned to, and the round in which the bound was measured. The bound is worth its value less the largest net displacement
of an entry of the group from that round's codebook to today's: the norm of the sum of its moves, never more than the sum
of their norms that bounds drifting from round to round would lose. Only groups whose bound does not exceed the distance to
the assigned entry, which is always measured, are scanned again, exactly and in integers; their bounds get today's stamp.
Comparisons leave room for rounding, so the result is that of a full scan.

Work: the table of codes and bounds is written once a round and read for the sums of the next codebook, which every task
adds up by itself; only entries x parts rows of sums, whose size does not depend on the rows, come to the driver. The
codebooks that go to the tasks are rounds x entries x components numbers.

Rows: a vector that is null or has a null or non-finite component is left out, and so is one whose length differs from that
of the smallest vec_id that stays. With fewer than 256 vectors there are fewer entries. A length that 4 does not divide is
cut at its rounded-down quarters; empty vectors have distance 0. A null vec_id is kept and comes last; equal vec_ids follow
the order of their components. Components saturate where squared distances would leave 64 bits, beyond about 2**18 for 16
components a part, and sums of errors at the largest 64-bit number. An empty table gives an empty result. Other columns
of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, forget, stored

SCALE, PARTS, ENTRIES, ROUNDS, GROUPS = 1024, 4, 256, 4, 8
SLACK = 1e-9  # relative room for rounding, far above that of the square roots
_EXACT = 2**52  # integers below are exact in floating point


def cuts(size: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(i * size // parts, (i + 1) * size // parts) for i in range(parts)]


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries, as 64-bit integers."""
    if not x.size or not entries.size:
        return np.zeros((len(x), len(entries)), np.int64)
    reach = int(np.abs(x).max()) + int(np.abs(entries).max())
    if reach * reach * x.shape[1] < _EXACT:  # then products in floating point are exact, too
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(entries)), np.int64)
    for j, entry in enumerate(entries):
        out[:, j] = ((x - entry) ** 2).sum(1)
    return out


def neighbourhoods(entries: np.ndarray, groups: int = GROUPS, rounds: int = 5) -> list[np.ndarray]:
    """Entries dealt to groups of near ones. Any dealing is right; near entries have bounds closer to their distances."""
    points = entries.astype(np.float64)
    centres = points[np.linspace(0, len(points) - 1, min(groups, len(points))).astype(int)]
    for _ in range(rounds):
        near = ((points[:, None] - centres) ** 2).sum(2).argmin(1)
        centres = np.array([points[near == g].mean(0) if (near == g).any() else centres[g] for g in range(len(centres))])
    found = [np.flatnonzero(near == g) for g in range(len(centres))]
    return found + [np.empty(0, np.int64)] * (groups - len(found))


@dataclass
class Book:
    """The codebooks of one part position in all rounds so far."""

    groups: list[np.ndarray]
    rounds: list[np.ndarray]

    def net(self) -> np.ndarray:
        """Per round and group, how far an entry of the group is from where it was in that round, at most."""
        now = self.rounds[-1].astype(np.float64)
        moved = np.array([np.sqrt(((now - then) ** 2).sum(1)) for then in self.rounds])
        return np.stack([moved[:, g].max(1) if len(g) else np.zeros(len(moved)) for g in self.groups], 1) * (1 + SLACK)


def assign(x: np.ndarray, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray, book: Book) -> tuple[np.ndarray, ...]:
    """New codes, bounds, stamps and exact squared errors of one part position, and how many distances were measured."""
    now, entries = len(book.rounds) - 1, book.rounds[-1]
    code, bound, stamp = code.copy(), bound.copy(), stamp.copy()
    own = ((x - entries[code]) ** 2).sum(1)  # the entry assigned so far, in integers
    net = book.net()
    worth = bound - net[stamp, np.arange(len(book.groups))]
    open_ = worth <= (np.sqrt(own.astype(np.float64)) * (1 + SLACK))[:, None]
    best, place = own.copy(), code.copy()
    scans, measured = [], len(x)
    for g, members in enumerate(book.groups):
        rows = np.flatnonzero(open_[:, g])
        if not len(rows) or not len(members):
            continue
        found = squared(x[rows], entries[members])
        measured += found.size
        first = found.argmin(1)  # ties go to the lower index, as members ascend
        least = found[np.arange(len(rows)), first]
        found[np.arange(len(rows)), first] = np.iinfo(np.int64).max
        second = found.min(1)
        index = members[first]
        scans.append((g, rows, index, least, second))
        better = (least < best[rows]) | ((least == best[rows]) & (index < place[rows]))
        best[rows[better]], place[rows[better]] = least[better], index[better]
    group_of = np.empty(len(entries), np.int64)
    for g, members in enumerate(book.groups):
        group_of[members] = g
    # an entry that was left counts again in the bound of its group
    left = np.flatnonzero(place != code)
    g = group_of[code[left]]
    bound[left, g] = np.minimum(worth[left, g], np.sqrt(own[left].astype(np.float64)) * (1 - SLACK))
    stamp[left, g] = now
    for g, rows, index, least, second in scans:
        other = np.where(index == place[rows], second, least).astype(np.float64)
        other[other >= 2.0**63] = np.inf
        bound[rows, g] = np.sqrt(other) * (1 - SLACK)
        stamp[rows, g] = now
    return place, bound, stamp, best, measured


def rounded_down(bound: np.ndarray) -> np.ndarray:
    """Half the bytes, and never above the bound."""
    small = bound.astype(np.float32)
    return np.where(small > bound, np.nextafter(small, np.float32(-np.inf)), small)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(values) + 1) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel(), kind))


def _assigned(books: list[Book], size: int, known: bool):
    """One round over a table: x, and from the second round on codes, bounds and stamps of the round before."""
    n_groups = len(books[0].groups)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = _matrix(batch.column("x"), size).astype(np.int64)
            codes, errors = np.zeros((n, len(books)), np.int64), np.zeros(n, np.int64)
            bounds = np.full((n, len(books), n_groups), -np.inf)
            stamps = np.zeros((n, len(books), n_groups), np.int64)
            if known:
                codes = _matrix(batch.column("codes"), len(books)).astype(np.int64)
                bounds = _matrix(batch.column("bounds"), bounds[0].size if n else 1).reshape(bounds.shape).astype(np.float64)
                stamps = _matrix(batch.column("stamps"), stamps[0].size if n else 1).reshape(stamps.shape).astype(np.int64)
            for p, (book, (a, b)) in enumerate(zip(books, cuts(size, len(books)))):
                codes[:, p], bounds[:, p], stamps[:, p], error, _ = assign(x[:, a:b], codes[:, p], bounds[:, p], stamps[:, p], book)
                errors += error
            yield batch_of(
                vec_id=batch.column("vec_id"), label=batch.column("label"), x=batch.column("x"),
                codes=_lists(codes, pa.int16()), bounds=_lists(rounded_down(bounds).reshape(n, -1), pa.float32()),
                stamps=_lists(stamps.reshape(n, -1), pa.int8()), error=pa.array(errors, pa.int64()),
            )

    return run


_STATE = "vec_id long, label string, x array<int>, codes array<short>, bounds array<float>, stamps array<byte>, error long"


def _sums(size: int, parts: int, entries: int):
    """Counts and component sums per part position and entry, over all rows of a task."""
    spans = cuts(size, parts)
    width = max(b - a for a, b in spans)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            x, codes = _matrix(batch.column("x"), size).astype(np.int64), _matrix(batch.column("codes"), parts)
            for p, (a, b) in enumerate(spans):
                order = np.argsort(codes[:, p], kind="stable")
                used, first = np.unique(codes[order, p], return_index=True)
                if len(used):
                    counts[p, used] += np.diff(np.append(first, len(order)))
                    if b > a:
                        sums[p, used, : b - a] += np.add.reduceat(x[order, a:b], first)
        part, entry = np.nonzero(counts)
        yield batch_of(
            part=pa.array(part, pa.int32()), entry=pa.array(entry, pa.int32()),
            n=pa.array(counts[part, entry], pa.int64()), sums=_lists(sums[part, entry], pa.int64()),
        )

    return run, width


def moved(state: DataFrame, books: list[Book], size: int) -> None:
    """Append the next codebooks: floored means, and where an entry has no part, the entry as it was."""
    entries = len(books[0].rounds[-1])
    add, width = _sums(size, len(books), entries)
    rows = state.select("x", "codes").mapInArrow(add, "part int, entry int, n long, sums array<long>")
    wide = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    found = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect()  # parts x entries rows at most
    after = [book.rounds[-1].copy() for book in books]
    for r in found:
        values = [int(s) // r["n"] for s in r[3:]]
        after[r["part"]][r["entry"]] = values[: after[r["part"]].shape[1]]
    for book, entries_ in zip(books, after):
        book.rounds.append(entries_)


@dataclass
class Codes:
    rows: DataFrame  # vec_id, label, codes, error
    books: list[Book]

    def digest(self) -> str:
        numbers = (str(v) for book in self.books for v in book.rounds[-1].ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def kept(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and the components as integers, of the vectors that stay; all lengths."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.filter(F.col(vector_col).isNotNull() & finite)
    numbers = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * SCALE)
    return own.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), numbers.alias("x"))


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, groups: int = GROUPS,
) -> Codes:
    """Codes and errors of all vectors that stay, and the codebooks of all rounds."""
    scaled = kept(vectors, id_col, vector_col, label_col)
    first = scaled.orderBy(F.asc_nulls_last("vec_id"), "x").select(F.size("x").alias("n")).first()
    size = first.n if first else 0
    limit = min((isqrt(2**62 // max(b - a, 1)) - 1) // 2 for a, b in cuts(size, parts))
    whole = F.transform("x", lambda x: F.floor(F.least(F.greatest(x, F.lit(float(-min(limit, 2**30)))), F.lit(float(min(limit, 2**30))))).cast("int"))
    table = stored(scaled.filter(F.size("x") == size).withColumn("x", whole), "vectors")
    least = table.orderBy(F.asc_nulls_last("vec_id"), "x").select("x").limit(entries).collect()
    start = np.array([r.x for r in least], np.int64).reshape(len(least), size)
    if not len(start):
        empty = table.select("vec_id", "label", F.array().cast("array<short>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return Codes(empty, [Book([], [np.empty((0, 0), np.int64)]) for _ in range(parts)])
    books = [Book(neighbourhoods(start[:, a:b], groups), [start[:, a:b]]) for a, b in cuts(size, parts)]
    for n in range(rounds + 1):
        state = stored(table.mapInArrow(_assigned(books, size, known=n > 0), _STATE), f"codes{n}")
        forget(table)
        table = state
        if n < rounds:
            moved(table, books, size)
    return Codes(table.select("vec_id", "label", "codes", "error"), books)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """The rows with the sum of errors over all rows of the same label; rows without label have one sum together."""
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    # a stored table has a known size: Spark sends it to all tasks when it is small, and splits hot labels otherwise
    totals = stored(sums, "labels").withColumnRenamed("label", "of")
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")
