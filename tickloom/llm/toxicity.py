"""Toxicity by multiple-instance learning: a document is toxic when one of its sentences is.

Only documents carry labels. A sentence with words of the model has probability p = sigmoid(bias + weights of its words),
a document 1 - (1 - q) * prod(1 - p) over these sentences (noisy-or), and the likelihood of the document labels is raised
by gradient steps. q = sigmoid(leak) stands once in each document for what no word explains, so a document without any
word of the model scores q however long it is. The sentences with p >= 0.5 are then the offending ones.

The model is fitted on at most TRAIN_DOCS labelled documents in expectation, chosen by a hash of their id; of
copies and near copies, found by shared min-hashes, one or a few are used, so that a group of copies weighs as one text.
Words and beginnings of words enter the model when they are found at least LIFT times as often in toxic documents and between at least LEAST
different pairs of neighbours there, at most WORDS of them. Every document is scored over its whole text. Words are runs of ASCII letters and digits and of all other characters beyond
ASCII, with A-Z lower-cased; sentences end at . ! ? and line ends.

Rows: a null or empty text, or one without words, has no sentence and scores 0; repeated rows score equally; labels that
are null or have no document are not used, of several labels for one id the highest counts. Without any positive label
all scores are 0. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, stored, texts_of, worker_cache

TRAIN_DOCS, WORDS, LIFT, LEAST = 10_000, 1024, 3.0, 5
PREFIXES = (5, 6, 8)
MARKS = 4
STEPS, RATE, SHRINK = 400, 0.1, 1e-4
CUT = 0.5

_ENDS = b".!?\n\r"
_TABLE = bytes(
    ord("\n") if b in _ENDS else b if b >= 128 or chr(b).isalnum() else ord(" ") for b in range(256)
).lower()  # bytes.lower() changes A-Z alone


def plain(text: bytes | None) -> bytes:
    """Same length: words in lower case, sentences ended by line feeds, blanks elsewhere."""
    return (text or b"").translate(_TABLE)


def features(word: bytes) -> tuple[bytes, ...]:
    """The word, ended by $, and its beginnings of PREFIXES bytes, ended by *: inflected forms share what they begin with."""
    return (word + b"$", *(word[:n] + b"*" for n in PREFIXES if len(word) > n))


class _Known(dict):
    """Words with the model's features in them; forgets all beyond a number of words, which bounds memory only."""

    def __init__(self, names: Iterable[bytes], limit: int = 300_000):
        super().__init__()
        self.names, self.limit = frozenset(names), limit

    def __missing__(self, word: bytes) -> frozenset:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = self.names.intersection(features(word))
        return found

    def of(self, words: Iterable[bytes]) -> frozenset:
        return frozenset().union(*filter(None, map(self.__getitem__, words)))


@dataclass
class Model:
    bias: float
    weights: dict[bytes, float] = field(default_factory=dict)
    leak: float | None = None  # logit, once in a document; without it each sentence without a word of the model has the bias

    def __post_init__(self) -> None:
        self.key = hashlib.sha256(repr(sorted(self.weights)).encode()).hexdigest()

    @property
    def known(self) -> _Known:
        return worker_cache("toxicity", self.key, lambda: _Known(self.weights))

    def sentences(self, text: bytes | None) -> Iterator[tuple[int, int, float]]:
        """Byte range and logit of each sentence with a word; with a leak, with a word of the model."""
        at, known = 0, self.known
        for sentence in plain(text).split(b"\n"):
            words = sentence.split()
            if words and ((found := known.of(words)) or self.leak is None):
                yield at, at + len(sentence), self.bias + sum(self.weights[w] for w in sorted(found))
            at += len(sentence) + 1

    def score(self, text: bytes | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of the sentences, and the offending ones as byte ranges with their probabilities."""
        low = plain(text)
        if not self.known.of(set(low.split())):
            n = sum(1 for s in low.split(b"\n") if s.strip())
            n, z = (n, self.bias) if self.leak is None else (min(n, 1), self.leak)
            return float(-np.expm1(-n * np.logaddexp(0, z))), []
        parts = list(self.sentences(text))
        logits = np.array([z for _, _, z in parts])
        chance = 1 / (1 + np.exp(-logits))
        hits = [(a, b, float(p)) for (a, b, _), p in zip(parts, chance) if p >= CUT]
        unexplained = 0.0 if self.leak is None else np.logaddexp(0, self.leak)
        return float(-np.expm1(-np.logaddexp(0, logits).sum() - unexplained)), hits


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, skip: F.Column | None = None) -> DataFrame:
    """doc_id, text, toxic of about `limit` labelled documents at most; `skip` is true of labels rows never to learn from."""
    known = labels.filter("toxic is not null and doc_id is not null")
    if skip is not None:
        known = known.filter(~skip)
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if n > limit:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * limit / n))
    sample = F.broadcast(known)  # about `limit` rows of two numbers
    texts = texts_of(docs)
    return texts.join(sample, texts.doc_id == sample.id).select("doc_id", "text", "toxic")


def _marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in plain form with a hash, and MARKS min-hashes of three-word shingles, which copies and near copies share."""
    turn = np.arange(1, 2 * MARKS, 2, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)  # odd multipliers
    for batch in batches:
        low = [plain(t.as_py()) for t in batch.column("text").cast(pa.binary())]
        marks = []
        for text in low:
            words = text.split()
            hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))]
            marks.append((np.array(hashes, np.uint64)[None, :] * turn).min(axis=1).view(np.int64).tolist())
        own = [xxhash.xxh64_intdigest(t) >> 1 for t in low]
        yield batch_of(
            text=pa.array(low, pa.binary()), toxic=batch.column("toxic"),
            own=pa.array(own, pa.int64()), marks=pa.array(marks, pa.list_(pa.int64())),
        )


def _apart(rows: DataFrame) -> DataFrame:
    """The rows that share no mark with a row of a smaller hash, so one of each group of near copies at least."""
    marks = rows.select("own", F.posexplode("marks").alias("turn", "mark"))
    least = marks.groupBy("turn", "mark").agg(F.min("own").alias("least"))
    later = marks.join(least, ["turn", "mark"]).filter("own > least").select("own").distinct()
    return rows.join(later, "own", "left_anti").dropDuplicates(["own"])


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, toxic = Counter(), Counter()
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            names = {f for w in set(text.as_py().split()) for f in features(w)}
            docs.update(names)
            if label:
                toxic.update(names)
        words = list(docs)
        yield batch_of(
            word=pa.array(words, pa.binary()),
            docs=pa.array(docs.values(), pa.int64()),
            toxic=pa.array([toxic[w] for w in words], pa.int64()),
        )


def _contexts(words: list[bytes]):
    """Each place of the given words: the word, a hash of its neighbours, the label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(words)
        for batch in batches:
            found = set()
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                own = [b"", *text.as_py().split(), b""]
                for i in range(1, len(own) - 1):
                    for name in known[own[i]]:
                        found.add((name, xxhash.xxh64_intdigest(own[i - 1] + b" " + own[i + 1]) >> 1, label))
            rows = sorted(found)
            yield batch_of(
                word=pa.array([w for w, _, _ in rows], pa.binary()), context=pa.array([c for _, c, _ in rows], pa.int64()),
                toxic=pa.array([x for _, _, x in rows], pa.int32()),
            )

    return run


def _bags(words: list[bytes]):
    """doc, toxic, the numbers of the model's words in a sentence, and how many of the document's sentences have just these.

    Each document with a sentence has one row without words, for the leak.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known = {w: i for i, w in enumerate(words)}, _Known(words)
        for batch in batches:
            doc, toxic, found, n = [], [], [], []
            marks, labels = batch.column("own").to_pylist(), batch.column("toxic").to_pylist()
            for mark, text, label in zip(marks, batch.column("text"), labels):
                sentences = filter(None, (s.split() for s in text.as_py().split(b"\n")))
                bags = Counter(tuple(sorted(number[w] for w in known.of(s))) for s in sentences)
                if bags:
                    bags[()] = 1
                for bag, count in sorted(bags.items()):
                    doc.append(mark)
                    toxic.append(label)
                    found.append(bag)
                    n.append(count)
            yield batch_of(
                doc=pa.array(doc, pa.int64()), toxic=pa.array(toxic, pa.int32()),
                bag=pa.array(found, pa.list_(pa.int32())), n=pa.array(n, pa.int64()),
            )

    return run


def raise_likelihood(
    doc: np.ndarray, label: np.ndarray, n: np.ndarray, bags: list, start: np.ndarray
) -> tuple[float, np.ndarray, float]:
    """Bias, weights and leak, from the weights of `start`; an empty bag has the leak alone; doc[i] numbers the document of sentence kind i, which occurs n[i] times in it; label is per document."""
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    column = np.fromiter((w for b in bags for w in b), np.int64, len(row))
    words = len(start)
    empty = np.fromiter((not b for b in bags), bool, len(bags))
    theta = np.concatenate(([-6.0], start, [-6.0]))
    step, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        z = np.where(empty, theta[-1], theta[0] + np.bincount(row, theta[1:-1][column], len(n)))
        clean = np.minimum(-np.bincount(doc, n * np.logaddexp(0, z), len(label)), -1e-9)  # log of the chance of no toxic sentence
        pull = np.where(label, -1 / np.expm1(-clean), 1.0)[doc] * n / (1 + np.exp(-z))
        slope = np.concatenate(([pull[~empty].sum()], np.bincount(column, pull[row], words), [pull[empty].sum()])) / len(label)
        slope[1:-1] += SHRINK * (theta[1:-1] - start)  # a word that decides nothing keeps its odds
        step = 0.9 * step + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        theta -= RATE * (step / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
    return float(theta[0]), theta[1:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, skip: F.Column | None = None) -> Model:
    """Fits on a bounded sample; what comes to the driver are at most WORDS words and the sample's sentence kinds."""
    rows = training_rows(docs, labels, limit, skip).select("text", "toxic")
    rows = rows.mapInArrow(_marks, "text binary, toxic int, own long, marks array<long>")
    one = stored(_apart(stored(rows, "labelled")), "distinct")
    total, positive = one.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not positive:
        return Model(-np.inf)
    counts = one.mapInArrow(_word_counts, "word binary, docs long, toxic long")
    counts = counts.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
    share = positive / total
    often = counts.filter(F.col("toxic") >= LEAST).filter(F.col("toxic") / F.col("docs") >= min(LIFT * share, (1 + share) / 2))
    surprise = (F.col("toxic") - F.col("docs") * share) / F.sqrt(F.col("docs") * share)
    words = [bytes(r.word) for r in often.orderBy(surprise.desc(), "word").select("word").take(WORDS)]
    # near copies repeat a word with its neighbours; what counts is in how many surroundings it is found
    places = one.mapInArrow(_contexts(words), "word binary, context long, toxic int")
    places = places.groupBy("word", "context").agg(F.max("toxic").alias("toxic"))
    places = places.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("all")).filter(F.col("toxic") >= LEAST)
    kept = {bytes(r.word): (r.toxic + 0.5) / (r.all - r.toxic + 0.5) for r in places.collect()}
    words = [w for w in words if kept.get(w, 0) > min(LIFT, 1 / (1 - share)) * share / (1 - share)]
    start = np.array([np.log(kept[w] * (1 - share) / share) for w in words])
    bags = one.mapInArrow(_bags(words), "doc long, toxic int, bag array<int>, n long").toPandas().sort_values(["doc", "n"], kind="stable")
    ids, doc = np.unique(bags.doc.to_numpy(), return_inverse=True)
    label = np.zeros(len(ids), bool)
    label[doc] = bags.toxic.to_numpy() > 0
    bias, weights, leak = raise_likelihood(doc, label, bags.n.to_numpy().astype(float), bags.bag.tolist(), start)
    return Model(bias, {w: float(x) for w, x in zip(words, weights) if x > 0}, leak)


def code_points(text: bytes, ranges: list[tuple[int, int, float]]) -> Iterator[tuple[int, int]]:
    """Ranges of bytes, in order and apart, as ranges of code points; every byte is read once."""
    at = points = 0
    for a, b, _ in ranges:
        start = points + len(text[at:a].decode())
        points = start + len(text[a:b].decode())
        at = b
        yield start, points


def _scores(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in blocks(batches):
            found = [model.score(t) for t in texts]
            spans = [
                [{"start": a, "end": b, "score": p} for (a, b), (_, _, p) in zip(code_points(t or b"", hits), hits)]
                for t, (_, hits) in zip(texts, found)
            ]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield batch_of(
                doc_id=pa.array(ids, pa.int64()), score=pa.array([s for s, _ in found], pa.float64()), sentences=pa.array(spans, kind)
            )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, and the offending sentences as ranges of code points."""
    schema = "doc_id long, score double, sentences array<struct<start: long, end: long, score: double>>"
    return texts_of(docs, id_col, text_col).mapInArrow(_scores(model), schema)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with a score below CUT, all columns unchanged."""
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary())
            yield batch.filter(pa.array([model.score(t.as_py())[0] < CUT for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
