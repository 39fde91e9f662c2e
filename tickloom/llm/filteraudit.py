"""Interaction audit of quality filters over a sparse document-term matrix.

One pass over the texts cuts them into blocks of whole documents. A block numbers its own words, in the order of a hash, and
holds its documents as compressed sparse rows (indptr, indices, data) in these numbers. The words are then numbered globally:
hash ranges make buckets, whose number grows with the words, a block sends each bucket its slice of words as one row, and
the bucket numbers the different ones and answers with the numbers of the slice. A block sends each of its words once, so
the most frequent word comes as often as there are blocks and no key is hot, and there are never more rows than words. The
shards of the matrix are built from the blocks and their answers. A document's row sum is its number of words and its number
of stored entries that of its different words; these decide filters A and B. C, D and a digest of the text travel with the
rows, E follows from the smallest id of a digest, and the audit adds up documents by the set of filters that they fail, of
which there are 32 per part.

Filters (a document fails): A under 200 words; B less than half of its words different; C more than 2 % capitals A-Z;
D holds one of # $ % & * |; E its text has a smaller doc_id.

Rows: a null text counts as empty, a null part as the empty string. A row without doc_id is counted, has no labels and takes
no part in E: it neither fails it nor makes others fail. Rows that repeat an id and a text are all counted and none fails E
for the other. Labels that repeat a doc_id count as 1 when one of them is 1. An empty table gives an empty result. A document
of any length is a block by itself. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, forget, numbering, stored, stretches

LETTERS = "ABCDE"
BLOCK = 8_000_000  # bytes of text in a block, or one longer document
BUCKET = 250_000  # words that a bucket numbers, counted once per block, at the mean

_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = re.compile(rb"[#$%&*|]")
_ROW = pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("capitals", pa.bool_()), ("marks", pa.bool_())])
_ROWS = "array<struct<doc_id: long, part: string, digest: binary, capitals: boolean, marks: boolean>>"


def _coded(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, (ids, texts) in enumerate(blocks(batches, size)):
            own, rows, sizes, found = numbering(), [], [], []
            for i, text in zip(ids, texts):
                text = text or b""
                numbers = [np.fromiter(map(own.__getitem__, words), np.int64, len(words)) for words in map(bytes.split, stretches(text))]
                found += numbers
                sizes.append(sum(map(len, numbers)))
                capitals = len(text) - len(text.translate(None, _CAPITALS))
                length = len(text) if text.isascii() else len(text.decode("utf-8"))
                rows.append({
                    "doc_id": i["id"], "part": i["part"], "digest": hashlib.sha256(text).digest(),
                    "capitals": 100 * capitals > 2 * length, "marks": _MARKS.search(text) is not None,
                })
            words = list(own)
            own.clear()
            order = np.argsort(_hashes(words), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            entries = np.repeat(np.arange(len(sizes)) << 32, sizes) | place[np.concatenate([np.empty(0, np.int64), *found])]
            entries.sort()
            firsts = np.flatnonzero(np.diff(entries, prepend=-1))
            data = np.diff(firsts, append=len(entries))
            indptr = np.searchsorted(entries[firsts] >> 32, np.arange(len(sizes) + 1))
            yield batch_of(
                # no other task gives this number
                block=pa.array([(TaskContext.get().partitionId() << 32) + n], pa.int64()),
                rows=pa.array([rows], pa.list_(_ROW)),
                n=pa.array([len(words)], pa.int64()),
                words=pa.array([b" ".join([words[i] for i in order.tolist()])], pa.binary()),
                indptr=pa.array([indptr.astype("<i8").tobytes()], pa.binary()),
                indices=pa.array([entries[firsts].astype("<u4").tobytes()], pa.binary()),
                data=pa.array([data.astype("<u4").tobytes()], pa.binary()),
            )

    return run


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def coded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", size: int = BLOCK) -> DataFrame:
    """One row per block: its documents, its words (joined by blanks), and its sparse rows in the places of these words."""
    doc = F.struct(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    texts = docs.select(doc.alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"block long, rows {_ROWS}, n long, words binary, indptr binary, indices binary, data binary"
    return stored(texts.mapInArrow(_coded(size), schema), "coded")


def _dealt(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, joined in zip(batch.column("block").to_pylist(), batch.column("words")):
                words = joined.as_py().split()
                bucket = _hashes(words) * np.uint64(buckets) >> np.uint64(32)  # ascending, as the words are
                cuts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)).tolist()
                slices = [b" ".join(words[a:b]) for a, b in zip(cuts, [*cuts[1:], len(words)])]
                yield batch_of(
                    bucket=pa.array(bucket[cuts].astype(np.int64)), block=pa.array([block] * len(cuts), pa.int64()),
                    first=pa.array(cuts, pa.int64()), words=pa.array(slices, pa.binary()),
                )

    return run


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the words of one bucket after the other, in order of the blocks, so that a task that runs again gives the same."""
    own, last = numbering(), None
    for batch in batches:
        numbers = []
        for bucket, joined in zip(batch.column("bucket").to_pylist(), batch.column("words")):
            if bucket != last:
                own, last = numbering(), bucket
            words = joined.as_py().split()
            numbers.append(np.fromiter(map(own.__getitem__, words), "<u4", len(words)).tobytes())
        yield batch_of(**{n: batch.column(n) for n in ("bucket", "block", "first", "words")}, numbers=pa.array(numbers, pa.binary()))


def numbered(blocks_: DataFrame, words: int = BUCKET) -> DataFrame:
    """bucket, block, first, words, numbers: a block's words from the place `first` on, and their numbers in the bucket."""
    total = blocks_.agg(F.sum("n")).first()[0] or 0
    sent = blocks_.select("block", "words").mapInArrow(_dealt(total // words + 1), "bucket long, block long, first long, words binary")
    schema = "bucket long, block long, first long, words binary, numbers binary"
    return sent.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(_numbered, schema)


def _spelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, joined, numbers in zip(batch.column("bucket").to_pylist(), batch.column("words"), batch.column("numbers")):
            words = pa.array(joined.as_py().split(), pa.binary()).cast(pa.string())
            yield batch_of(word=words, number=pa.array(np.frombuffer(numbers.as_py(), "<u4").astype(np.int64) + (bucket << 32)))


def dictionary(numbers: DataFrame) -> DataFrame:
    """word and number, one row per different word of all documents."""
    return numbers.select("bucket", "words", "numbers").mapInArrow(_spelled, "word string, number long").distinct()


def _shard(block: pa.Table, numbers: pa.Table) -> pa.Table:
    """A block with its words' numbers, as a shard of the matrix over all words."""
    own = [np.empty(0, np.int64)]
    for row in sorted(numbers.to_pylist(), key=lambda r: r["first"]):
        own.append(np.frombuffer(row["numbers"], "<u4").astype("<i8") + (row["bucket"] << 32))
    places = np.frombuffer(block.column("indices")[0].as_py(), "<u4")
    of_all = pa.array([np.concatenate(own)[places].tobytes()], pa.binary())
    return block.set_column(block.schema.get_field_index("indices"), "indices", of_all)


def _joined(blocks_: DataFrame, numbers: DataFrame):
    left = blocks_.select("block", "rows", "indptr", "indices", "data").groupBy("block")
    return left.cogroup(numbers.select("block", "bucket", "first", "numbers").groupBy("block"))


def shards(blocks_: DataFrame, numbers: DataFrame) -> DataFrame:
    """The document-term matrix by blocks: documents, and compressed sparse rows whose columns are the words' global numbers.

    indptr and indices are little-endian 64-bit numbers, data 32-bit ones. The columns of a row come in no order.
    """
    schema = f"block long, rows {_ROWS}, indptr binary, indices binary, data binary"
    return _joined(blocks_, numbers).applyInArrow(_shard, schema)


def _figures(block: pa.Table, numbers: pa.Table) -> pa.Table:
    """Sums and numbers of entries of a shard's rows, taken where the shard is made, so that it need not leave the task."""
    shard = _shard(block, numbers)
    indptr = np.frombuffer(shard.column("indptr")[0].as_py(), "<i8")
    data = np.frombuffer(shard.column("data")[0].as_py(), "<u4")
    rows = shard.column("rows")[0].values
    columns = dict(zip((f.name for f in rows.type), rows.flatten()))
    totals = np.concatenate(([0], np.cumsum(data, dtype=np.int64)))[indptr]
    return pa.table({**columns, "n_words": np.diff(totals), "n_distinct": np.diff(indptr)})


def figures(blocks_: DataFrame, numbers: DataFrame) -> DataFrame:
    """doc_id, part, digest, capitals, marks and the document's row sum (n_words) and stored entries (n_distinct)."""
    schema = "doc_id long, part string, digest binary, capitals boolean, marks boolean, n_words long, n_distinct long"
    return _joined(blocks_, numbers).applyInArrow(_figures, schema)


def failures(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (the letters, in order), n, n_good, n_toxic: the documents of a part by the filters they fail."""
    first = {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": F.col("capitals"),
        "D": F.col("marks"),
    }
    fails = F.concat(*(F.when(c, F.lit(letter)).otherwise(F.lit("")) for letter, c in first.items()))
    same = rows.select("digest", "doc_id", "part", fails.alias("fails")).groupBy("digest", "doc_id", "part", "fails")
    ones = same.agg(F.count(F.lit(1)).alias("n"))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = ones.join(marked, "doc_id", "left").withColumn("good", F.coalesce("good", F.lit(0))).withColumn("toxic", F.coalesce("toxic", F.lit(0)))
    # of one text, only the rows with the smallest id pass E: a text in a third of all rows shrinks before it is shuffled
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    without = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    grouped = known.groupBy("digest", "part", "fails", "good", "toxic").agg(least.alias("least"), F.sum("n").alias("n"), without.alias("without"))
    smallest = F.min("least.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("without") + F.when(F.col("least.doc_id") == smallest, F.col("least.n")).otherwise(0)
    split = F.explode(
        F.array(F.struct(F.col("fails"), F.col("passing").alias("n")), F.struct(F.concat("fails", F.lit("E")).alias("fails"), (F.col("n") - F.col("passing")).alias("n")))
    )
    parts = grouped.withColumn("passing", passing).select("part", "good", "toxic", split.alias("x"))
    return parts.groupBy("part", "x.fails").agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("n_good"), F.sum(F.col("x.n") * F.col("toxic")).alias("n_toxic")
    )


def interactions(sets: DataFrame) -> DataFrame:
    """Every part, order of the five filters and step, from the sets of failed filters."""
    orders = F.array(*(F.lit("".join(p)) for p in permutations(LETTERS)))
    steps = sets.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    before = F.substr("filter_order", F.lit(1), F.col("step") - 1)
    gone = F.call_function("translate", before, F.col("fails"), F.lit(""))
    removed_before = F.length(gone) < F.length(before)
    failing = F.contains(F.col("fails"), letter)
    here = failing & ~removed_before
    # a document failing k filters is removed first by each of them in a k-th of all 120 orders
    share = F.when(failing, F.col("n") * (120 / F.length("fails")).cast("long")).otherwise(0)

    def total(condition: F.Column, n: str, name: str) -> F.Column:
        return F.sum(F.when(condition, F.col(n)).otherwise(0)).alias(name)

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~failing & ~removed_before, "n", "kept"),
        total(here, "n", "removed"),
        total(failing & removed_before, "n", "redundant"),
        total(F.col("fails") == letter, "n", "unique_fails"),
        total(here, "n_good", "good_lost"),
        total(here, "n_toxic", "toxic_lost"),
        F.sum(share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, filter_order, step and the counts kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    blocks_ = coded(docs, id_col, text_col, part_col)
    rows = stored(figures(blocks_, numbered(blocks_)), "figures")
    forget(blocks_)
    sets = stored(failures(rows, labels), "failures")
    forget(rows)
    return interactions(sets)
