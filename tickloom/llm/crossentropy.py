"""Cross-entropy difference of two matched n-gram models.

Target and background model have one vocabulary (all words found at least LEAST times in all documents and one sign for
the rest), one order (two) and one smoothing, so that their losses differ only by what was counted. A word found once
cannot be in both folds, so its count tells nothing about any document. The background counts every document, the target
those marked as wanted. Documents are dealt to two folds by a hash of their id, and those of one fold are scored by the
models of the other, so no document is scored by its own counts. The score of a document is the mean over its tokens of
target loss minus background loss: the lower, the more like the target.

All counts of words and pairs of words are exact. Documents of a fold are put together in blocks of about BLOCK tokens.
A block sends each of its different words once, with its counts, to one of a number of buckets that grows with the tokens;
the bucket adds the counts of all blocks and answers each block with the sums of the other fold. Pairs follow the same
way. So a hot word or pair is one entry per block, a task holds one block or one bucket, and nothing that grows with the
corpus comes to the driver but nine sums per bucket.

Rows: a null or empty text has no tokens and scores 0; a null doc_id is kept and never wanted; repeated rows count and
score each. Without a wanted document the target model is even over the vocabulary. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, bounds, forget, stored, texts_of

LEAST = 2
BLOCK = 500_000  # tokens put together
BUCKET = 1_000_000  # tokens for each bucket
PAIR, FLOOR = 4.0, 0.5  # weight of the next lower order, in counts
COUNTED = 200_000  # different words a task counts before it sends them on

_BLOCKS = "block long, fold int, ids array<long>, sizes binary, tokens binary, words binary, n_tokens long"
_NUMBERED = "block long, fold int, ids array<long>, sizes binary, wanted array<int>, tokens binary, numbers binary, n binary, w binary"
_ASKED = "bucket int, block long, fold int, keys binary, n binary, w binary"
_ANSWERED = "bucket int, block long, numbers binary, n binary, w binary"


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case."""
    return (text or b"").lower().split()


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def sent() -> pa.RecordBatch:
        return batch_of(word=pa.array(list(counts), pa.binary()), n=pa.array(list(counts.values()), pa.int64()))

    for _, texts in blocks(batches, 1_000_000):
        for text in texts:
            counts.update(tokens_of(text))
        if len(counts) > COUNTED:
            yield sent()
            counts.clear()
    yield sent()


def last_word(docs: DataFrame, id_col: str, text_col: str, size: int) -> tuple[int, bytes]:
    """Count and text of the last of the `size` most frequent words; ties in order of the word."""
    counts = texts_of(docs, id_col, text_col).mapInArrow(_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    most = counts.orderBy(F.desc("n"), "word").limit(size)
    last = most.orderBy("n", F.desc("word")).first()
    return (last.n, bytes(last.word)) if last else (LEAST, b"")


def packed(values: np.ndarray, kind: str) -> bytes:
    """How many bytes a number needs, then all first bytes, all second bytes and so on, which compresses well; kind is little-endian."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values, kind).view(np.uint8).reshape(len(values), -1).T
    width = max(1, -(-int(np.max(values)).bit_length() // 8))
    return bytes([width]) + planes[:width].tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view(kind).ravel()


class _Numbers(dict):
    """Numbers words from 0 as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its documents, their sizes, their tokens as numbers of the block's own words."""
    task, made = TaskContext.get().partitionId(), 0
    held: dict[int, tuple] = {}

    def row(fold: int) -> pa.RecordBatch:
        nonlocal made
        ids, tokens, numbers, _ = held.pop(fold)
        made += 1
        return batch_of(
            block=pa.array([task << 32 | made], pa.int64()), fold=pa.array([fold], pa.int32()), ids=pa.array([ids], pa.list_(pa.int64())),
            sizes=pa.array([packed([len(t) for t in tokens], "<u4")], pa.binary()),
            tokens=pa.array([packed(np.concatenate(tokens), "<u4")], pa.binary()), words=pa.array([b"\n".join(numbers)], pa.binary()),
            n_tokens=pa.array([sum(map(len, tokens))], pa.int64()),
        )

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for i, (doc, fold) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("fold").to_pylist())):
            ids, tokens, numbers, size = held.setdefault(fold, ([], [], _Numbers(), [0]))
            found = tokens_of(texts[i].as_py())
            ids.append(doc)
            tokens.append(np.fromiter(map(numbers.__getitem__, found), "<u4", len(found)))
            size[0] += len(found) + 1
            if size[0] >= BLOCK:
                yield row(fold)
    for fold in list(held):
        yield row(fold)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _marked(row: dict) -> np.ndarray:
    """For each token of the block, whether its document is wanted."""
    sizes = unpacked(row["sizes"], "<u4")
    wanted = np.zeros(len(sizes), bool)
    wanted[row["wanted"] or []] = True
    return np.repeat(wanted, sizes)


def _word_order(row: dict, buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The block's words, the bucket of each, and their order by bucket."""
    words = row["words"].split(b"\n") if row["words"] else []
    bucket = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in words), np.int64, len(words))
    return words, bucket, np.argsort(bucket, kind="stable")


def _asked(row: dict, bucket: np.ndarray, order: np.ndarray, keys: Callable, n: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    """One row per bucket that the block has entries for."""
    used, starts = np.unique(bucket[order], return_index=True)
    parts = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)])]
    return batch_of(
        bucket=pa.array(used.astype(np.int32)), block=pa.array([row["block"]] * len(used), pa.int64()),
        fold=pa.array([row["fold"]] * len(used), pa.int32()), keys=pa.array(map(keys, parts), pa.binary()),
        n=pa.array([packed(n[p], "<u4") for p in parts], pa.binary()),
        w=pa.array([packed(w[p], "<u4") for p in parts], pa.binary()),
    )


def _asked_words(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, bucket, order = _word_order(row, buckets)
            tokens = unpacked(row["tokens"], "<u4")
            n, w = (np.bincount(t, minlength=len(words)) for t in (tokens, tokens[_marked(row)]))
            yield _asked(row, bucket, order, lambda part: b"\n".join([words[i] for i in part.tolist()]), n, w)

    return run


def _pairs(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of tokens after another one, the pair of each, the different pairs, the bucket of each pair, their order by bucket."""
    tokens, numbers = unpacked(row["tokens"], "<u4").astype(np.int64), unpacked(row["numbers"], "<u4").astype(np.uint64)
    after = np.ones(len(tokens), bool)
    starts = bounds(unpacked(row["sizes"], "<u4"))[:-1]
    after[starts[starts < len(tokens)]] = False
    at = np.flatnonzero(after)
    codes, pair = np.unique(tokens[at - 1] * len(numbers) + tokens[at], return_inverse=True)
    first, second = np.divmod(codes, max(len(numbers), 1))
    keys = numbers[first] << np.uint64(32) | numbers[second]
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    return at, pair, keys, bucket, np.argsort(bucket, kind="stable")


def _asked_pairs(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            at, pair, keys, bucket, order = _pairs(row, buckets)
            n, w = (np.bincount(p, minlength=len(keys)) for p in (pair, pair[_marked(row)[at]]))
            yield _asked(row, bucket, order, lambda part: packed(keys[part], "<u8"), n, w)

    return run


def _answered(buckets: int, counted_words: bool, last: tuple[int, bytes] | None = None):
    """Answers of whole buckets, whose rows lie together. Those about words number the vocabulary and add a row of sums without a block."""

    def answers(bucket: int, rows: list[dict]) -> pa.RecordBatch:
        if counted_words:
            index = _Numbers()
            places = [np.fromiter(map(index.__getitem__, ws), np.int64, len(ws)) for ws in (r["keys"].split(b"\n") for r in rows)]
            size = len(index)
        else:
            keys = [unpacked(r["keys"], "<u8") for r in rows]
            different, place = np.unique(np.concatenate(keys), return_inverse=True)
            places = np.split(place, bounds(map(len, keys))[1:-1])
            size = len(different)
        sums = np.zeros((2, 2, size), np.int64)  # fold, all or wanted
        for r, place in zip(rows, places):
            for k, name in enumerate("nw"):
                sums[r["fold"], k, place] += unpacked(r[name], "<u4")  # a block has each entry once
        numbers = np.zeros(size, np.int64)
        ends = []
        if counted_words:
            total = sums[0, 0] + sums[1, 0]
            if last is None:
                known = total >= LEAST
            else:
                known = np.fromiter(((-n, w) <= (-last[0], last[1]) for n, w in zip(total.tolist(), index)), bool, size)
            numbers[known] = 1 + np.arange(known.sum()) * buckets + bucket
            ends = [np.concatenate(([known.sum()], sums.sum(axis=2).ravel(), sums[:, :, ~known].sum(axis=2).ravel()))]
        others = [sums[1 - r["fold"]] for r in rows]
        none = [b""] * len(ends)
        return batch_of(
            bucket=pa.array([bucket] * (len(rows) + len(ends)), pa.int32()),
            block=pa.array([r["block"] for r in rows] + [None] * len(ends), pa.int64()),
            numbers=pa.array([packed(numbers[p], "<u4") if counted_words else b"" for p in places] + none, pa.binary()),
            n=pa.array([packed(o[0, p], "<i8") for o, p in zip(others, places)] + [e.astype("<i8").tobytes() for e in ends], pa.binary()),
            w=pa.array([packed(o[1, p], "<i8") for o, p in zip(others, places)] + none, pa.binary()),
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for row in _rows(batches):
            if row["bucket"] != now and rows:
                yield answers(now, rows)
                rows = []
            now = row["bucket"]
            rows.append(row)
        if rows:
            yield answers(now, rows)

    return run


def _found(row: dict, name: str, kind: str, order: np.ndarray) -> np.ndarray:
    """What the buckets answered, in the order of the block's own entries."""
    out = np.zeros(len(order), kind)
    out[order] = np.concatenate([out[:0], *(unpacked(x[name], kind) for x in row["found"] or [])])
    return out


def _numbered(buckets: int):
    """The blocks with their words in vocabulary numbers, 0 for the rest, and the other fold's counts of these."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, _, order = _word_order(row, buckets)
            numbers, place = np.unique(_found(row, "numbers", "<u4", order), return_inverse=True)
            counts = {}
            for name in "nw":
                counts[name] = np.zeros(len(numbers), "<i8")
                counts[name][place] = _found(row, name, "<i8", order)  # of the rest any; the sums have them
            tokens = place.astype("<u4")[unpacked(row["tokens"], "<u4")]
            yield batch_of(
                block=pa.array([row["block"]], pa.int64()), fold=pa.array([row["fold"]], pa.int32()),
                ids=pa.array([row["ids"]], pa.list_(pa.int64())), sizes=pa.array([row["sizes"]], pa.binary()),
                wanted=pa.array([row["wanted"]], pa.list_(pa.int32())), tokens=pa.array([packed(tokens, "<u4")], pa.binary()),
                numbers=pa.array([packed(numbers, "<u4")], pa.binary()),
                **{name: pa.array([packed(c, "<i8")], pa.binary()) for name, c in counts.items()},
            )

    return run


def _scored(buckets: int, size: int, all_tokens: np.ndarray, rest: np.ndarray):
    """Losses by interpolation: pair counts over word counts over an even distribution. all_tokens, rest: by fold, all or wanted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            at, pair, _, _, order = _pairs(row, buckets)
            tokens, numbers = unpacked(row["tokens"], "<u4"), unpacked(row["numbers"], "<u4")
            sizes = unpacked(row["sizes"], "<u4").astype(np.int64)
            doc, other = np.repeat(np.arange(len(sizes)), sizes), 1 - row["fold"]
            mean = []
            for k, name in enumerate("nw"):
                words = np.where(numbers == 0, rest[other, k], unpacked(row[name], "<i8")).astype(float)
                even = (words[tokens] + FLOOR) / (all_tokens[other, k] + FLOOR * (size + 1))
                seen, both = np.zeros((2, len(tokens)))
                seen[at] = words[tokens[at - 1]]
                both[at] = _found(row, name, "<i8", order)[pair]
                mean.append(np.bincount(doc, -np.log((both + PAIR * even) / (seen + PAIR)), len(sizes)) / np.maximum(sizes, 1))
            yield batch_of(
                doc_id=pa.array(row["ids"], pa.int64()), n_tokens=pa.array(sizes), ce_target=pa.array(mean[1]),
                ce_background=pa.array(mean[0]), score=pa.array(mean[1] - mean[0]),
            )

    return run


def _answers(asked: DataFrame, name: str, *how) -> DataFrame:
    rows = asked.repartition("bucket").sortWithinPartitions("bucket")
    return stored(rows.mapInArrow(_answered(*how), _ANSWERED), name)


def _with_answers(dealt: DataFrame, answers: DataFrame) -> DataFrame:
    found = F.sort_array(F.collect_list(F.struct("bucket", "numbers", "n", "w"))).alias("found")  # a block has one answer per bucket
    return dealt.join(answers.filter("block is not null").groupBy("block").agg(found), "block", "left")


def score(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int | None = None) -> DataFrame:
    """doc_id, n_tokens, mean losses ce_target and ce_background, score. wanted.doc_id: the target documents.

    With `size` the vocabulary is the so many most frequent words, whatever LEAST says.
    """
    last = None if size is None else last_word(docs, id_col, text_col, size)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold")
    raw = stored(texts_of(docs, id_col, text_col).select("doc_id", "text", fold).mapInArrow(_dealt, _BLOCKS), "blocks")
    # only ids are joined to find the wanted documents
    marks = wanted.select(F.col("doc_id").cast("long").alias("id")).filter("id is not null").distinct()
    places = raw.select("block", F.posexplode("ids").alias("place", "id")).join(marks, "id")
    places = places.groupBy("block").agg(F.collect_list("place").alias("wanted"))
    dealt = stored(raw.join(places, "block", "left"), "dealt")
    forget(raw)
    tokens = dealt.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = tokens // BUCKET + 1
    answers = _answers(dealt.mapInArrow(_asked_words(buckets), _ASKED), "words", buckets, True, last)
    sums = np.zeros(9, np.int64)
    for row in answers.filter("block is null").select("n").toLocalIterator():
        sums += np.frombuffer(row.n, "<i8")
    numbered = stored(_with_answers(dealt, answers).mapInArrow(_numbered(buckets), _NUMBERED), "numbered")
    forget(dealt, answers)
    answers = _answers(numbered.mapInArrow(_asked_pairs(buckets), _ASKED), "pairs", buckets, False)
    models = int(sums[0]), sums[1:5].reshape(2, 2), sums[5:].reshape(2, 2)
    schema = "doc_id long, n_tokens long, ce_target double, ce_background double, score double"
    return _with_answers(numbered, answers).mapInArrow(_scored(buckets, *models), schema)
