"""Packing token sequences: shortest-pack-first over the length histogram.

Documents are tokenized, an end id is added, and each is cut into pieces of at most `width` ids. The histogram of piece
lengths has at most `width` rows, so it is packed on the driver: lengths are placed longest first, always into the
packing pattern that is shortest so far, splitting its count where fewer pieces are left than packs. The result, a table
of rank ranges per length, is bounded by the number of patterns. Every piece then finds its sequence and offset from its
rank among the pieces of its length. The task that makes a piece numbers it among its own ones of that length, so a rank is
that number and the count in earlier tasks: one row per task of at most `width` counts is joined to the pieces, and no piece
is shuffled, sorted or ranked. Ids never leave the JVM again once they are stored.

Rows: a null text counts as empty and gives one piece with the end id; a null doc_id is kept; repeated rows are packed
each. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import Spelled, batch_of, blocks, bounds, forget, stored, stretches, texts_of, worker_cache

WIDTH, END = 2048, 1

# how word_bpe vocabularies cut a lower-cased text (fixed by the vocabulary file),
# in texts without other characters than ASCII, Latin letters, basic Cyrillic, and marks of punctuation and currency:
# these have one case mapping, and no digits but 0-9
_LETTERS = "\xc0-\xd6\xd8-\xf6\xf8-\xff\u0100-\u012f\u0132-\u0148\u014a-\u017e\u0400-\u045f"
_PLAIN = re.compile(f"[\x00-\x7f{_LETTERS}\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*\\Z")
_CUT = re.compile(f"[A-Za-z{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^A-Za-z{_LETTERS}0-9\t-\r\x20]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Cutter:
    """Texts as keys that are spelled by themselves, and the ids of a key.

    A text that needs no Unicode tables is cut here, into the parts (str) that the tokenizer's model sees; its words then
    share parts. Others are cut at blanks, and the whole tokenizer spells each stretch (bytes).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        names = (re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values())
        self.special = re.compile("|".join(names) or r"\Z.")
        # the usual printable stand-ins of the 256 bytes (fixed by byte-level vocabularies)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.table = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(shown))}

    def keys(self, raw: bytes) -> list:
        text = raw.decode("utf-8")
        if not (text.isascii() or _PLAIN.match(text)) or self.special.search(text):
            return raw.split()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return _CUT.findall(text.lower())

    def spell(self, keys: list) -> list[list[int]]:
        model, whole, table = self.model.tokenize, self.whole.encode, self.table
        return [
            [t.id for t in model(key if key.isascii() and key.isprintable() else key.encode().decode("latin-1").translate(table))]
            if type(key) is str
            else whole(key.decode("utf-8"), add_special_tokens=False).ids
            for key in keys
        ]


def _numbers(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each length's place among the equal ones, those `seen` before included, and adds to `seen`."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    first = np.searchsorted(ordered, ordered, side="left")
    out = np.empty(len(lengths), np.int64)
    out[order] = seen[ordered] + np.arange(len(lengths)) - first
    seen += np.bincount(lengths, minlength=len(seen))
    return out


def _pieces(path: str, width: int, end: int, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter: Cutter = worker_cache("packing", f"cutter {path}", lambda: Cutter(path))
        table: Spelled = worker_cache("packing", f"keys {path}", lambda: Spelled(cutter.spell, 400_000))
        task, seen = TaskContext.get().partitionId(), np.zeros(width + 1, np.int64)
        for ids, texts in blocks(batches):
            keys, sizes = [], []
            for text in texts:
                before = len(keys)
                for part in stretches(text or b""):
                    keys += cutter.keys(part)
                sizes.append(len(keys) - before)
            tokens, lengths = table.tokens(keys)
            at = bounds(lengths)[bounds(sizes)]
            totals = np.diff(at) + 1
            pieces = -(-totals // width)
            doc = np.repeat(np.arange(len(ids)), pieces)
            start = (np.arange(len(doc)) - np.repeat(bounds(pieces)[:-1], pieces)) * width
            length = np.minimum(totals[doc] - start, width)
            # the ids of all documents with their end ids, in one array
            data = memoryview(np.insert(tokens, at[1:], end).astype("<u4").tobytes())
            begins = bounds(totals)[:-1][doc] + start
            own = [data[4 * a : 4 * b] for a, b in zip(begins.tolist(), (begins + length).tolist())]
            columns = {"ids": pa.array(map(bytes, own), pa.binary())} if with_ids else {}
            yield batch_of(
                doc_id=pa.array([ids[i] for i in doc.tolist()], pa.int64()),
                start=pa.array(start, pa.int64()),
                length=pa.array(length, pa.int64()),
                doc_tokens=pa.array(totals[doc], pa.int64()),
                ids_crc32=pa.array(map(zlib.crc32, own), pa.int64()),
                task=pa.array(np.full(len(doc), task, np.int32)),
                number=pa.array(_numbers(length, seen)),
                **columns,
            )

    return run


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, width: int = WIDTH, end: int = END,
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, and ids (little-endian unsigned 32-bit numbers) per piece.

    task and number, the place among the pieces of its length that its task made, are for `pack`.
    """
    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, task int, number long" + (", ids binary" if with_ids else "")
    return texts_of(docs, id_col, text_col).mapInArrow(_pieces(path or default_tokenizer(), width, end, with_ids), schema)


def patterns(histogram: dict[int, int], width: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(packs, [(length, how often in each pack)]): every piece of the histogram lies in exactly one pack."""
    heap: list = []  # (ids so far, number, packs, runs): the shortest pattern first
    number = 0

    def put(total: int, packs: int, runs: tuple) -> None:
        nonlocal number
        heapq.heappush(heap, (total, number, packs, runs))
        number += 1

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > width:
                # one by one, each new pack stays the shortest until it has no room for this length
                times = width // length
                if left >= times:
                    put(length * times, left // times, ((length, times),))
                if left % times:
                    put(length * (left % times), 1, ((length, left % times),))
                break
            total, _, packs, runs = heapq.heappop(heap)
            used = min(packs, left)
            more = ((length, runs[-1][1] + 1),) if runs[-1][0] == length else (runs[-1], (length, 1))
            put(total + length, used, runs[:-1] + more)
            if packs > used:
                put(total, packs - used, runs)
            left -= used
    return [(packs, list(runs)) for _, _, packs, runs in heap]


def slots(found: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, times) in order of length and rank."""
    rows, ranks, sequence = [], {}, 0
    for packs, runs in found:
        offset = 0
        for length, times in runs:
            first = ranks.get(length, 0)
            rows.append((length, first, sequence, offset, times))
            ranks[length] = first + packs * times
            offset += length * times
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(found: DataFrame, width: int = WIDTH) -> DataFrame:
    """All rows of `pieces`, with sequence_id and offset."""
    rows = stored(found, "pieces")
    counts = stored(rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= width rows
    table = slots(patterns(histogram, width))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", F.struct("length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).alias("x"))
    # of known size: Spark sends it to all tasks when it is small, and joins by task otherwise
    bases = stored(base.groupBy("task").agg(F.map_from_entries(F.collect_list("x")).alias("bases")), "bases")
    forget(counts)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, rank = length.to_numpy(), rank.to_numpy()
        # the slots are in order of length and first rank: the last one that does not lie behind
        key = np.searchsorted(table[:, 0], n, side="left")
        sequence, offset = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for k in np.unique(key).tolist():
            own = np.flatnonzero(key == k)
            own_slots = table[k : np.searchsorted(table[:, 0], table[k, 0], side="right")]
            slot = own_slots[np.searchsorted(own_slots[:, 1], rank[own], side="right") - 1]
            past = rank[own] - slot[:, 1]
            sequence[own] = slot[:, 2] + past // slot[:, 4]
            offset[own] = slot[:, 3] + past % slot[:, 4] * slot[:, 0]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    names = [c for c in rows.columns if c not in ("task", "number")]
    rank = F.struct((F.col("number") + F.col("bases")[F.col("length")]).alias("rank"))
    # through a one-row inline, so that the bases are dropped before rows wait for Python
    ranked = rows.join(bases, "task").select(*names, F.inline(F.array(rank)))
    return ranked.withColumn("place", place("length", "rank")).select(*names, "place.sequence_id", "place.offset")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and the ids of its pieces in order, for placed pieces that still carry ids; a row holds at most `width` ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id", F.expr("aggregate(inside, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")
    )
