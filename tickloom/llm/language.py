"""Language identification of words, spans and documents.

Training counts character 2- to 4-grams of words per language in BUCKETS hashed cells, and letters per script. A word's
score for a language is the log-likelihood of its n-grams. Script ranges narrow the candidates first: a language in which
a script holds less than RARE of the letters seen is out for words of that script. Over the words of a document a Viterbi
pass, which pays SWITCH for each change of language, labels every word; runs of one label are the spans. The document's
language is the one with most letters, its score that language's share of the letters.

The model is fitted on at most TRAIN_DOCS documents per language in expectation, chosen by a hash of their id; every
document is labelled over its whole text.

Rows: a null text, or one without a letter, is `und` with score 0; a null or empty language is not learned; repeated rows
get equal results; ties go to the language first in order. Without any language learned all rows are `und`. An empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, bounds, gather, texts_of, worker_cache

TRAIN_DOCS, BUCKETS, SWITCH, RARE = 5000, 1 << 16, 12.0, 0.001
SIZES = (2, 3, 4)
ALPHA = 0.05
OUT = -1e6  # the score of a language whose script a word is not in
WORDS = 600_000  # words a worker remembers; it forgets all beyond
CHUNK = 20_000  # words whose n-grams are held at once

# first code points of the ranges told apart (fixed by Unicode blocks); a range ends where the next begins
RANGES = (
    (0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x780, "other"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "other"), (0xE00, "thai"), (0xE80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x323B0, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in RANGES))
_FIRST = [at for at, _ in RANGES]
_SCRIPT = [SCRIPTS.index(name) for _, name in RANGES]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all n-grams of all words, each between blanks, and how many each word has."""
    text = " " + " ".join(words) + " "
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - (sizes + 1)  # of the blank before each word
    cells, counts = [], []
    for n in SIZES:
        number = np.maximum(sizes + 2 - n + 1, 0)
        value = np.zeros(max(len(points) - n + 1, 0), np.uint64)
        for i in range(n):
            value = value * np.uint64(0x100000001B3) + points[i : i + len(value)]
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        cells.append(gather((value >> np.uint64(40)).astype(np.int64) % BUCKETS, starts, number))
        counts.append(number)
    total = sum(counts)
    place = np.concatenate([np.repeat(np.arange(len(words)), c) for c in counts])
    return np.concatenate(cells)[np.argsort(place, kind="stable")], total


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word, and the script of its first letter (-1 without one)."""
    count, script = np.zeros(len(words), np.int64), np.full(len(words), -1)
    for i, word in enumerate(words):
        own = word if word.isalpha() else "".join(filter(str.isalpha, word))
        if own:
            count[i] = len(own)
            script[i] = _SCRIPT[bisect_right(_FIRST, ord(own[0])) - 1]
    return count, script


def words_of(text: bytes | None) -> list[str]:
    return (text or b"").decode("utf-8").lower().split()


def _counted(languages: list[str]):
    """(kind, language, cell, n): n-grams (kind 0) and letters by script (kind 1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(languages)}
        cells = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), len(SCRIPTS)), np.int64)
        for batch in batches:
            found: dict[int, Counter] = {}
            for text, lang in zip(batch.column("text").cast(pa.binary()), batch.column("lang").to_pylist()):
                found.setdefault(number[lang], Counter()).update(words_of(text.as_py()))
            for lang, counter in found.items():
                every, often = list(counter), np.fromiter(counter.values(), np.int64, len(counter))
                for at in range(0, len(every), CHUNK):
                    words, times = every[at : at + CHUNK], often[at : at + CHUNK]
                    own, sizes = grams(words)
                    cells[lang] += np.bincount(own, np.repeat(times, sizes), BUCKETS).astype(np.int64)
                    count, script = letters(words)
                    real = script >= 0
                    scripts[lang] += np.bincount(script[real], (count * times)[real], len(SCRIPTS)).astype(np.int64)
        for kind, table in enumerate((cells, scripts)):
            lang, cell = np.nonzero(table)
            yield batch_of(
                kind=pa.array(np.full(len(lang), kind, np.int32)), lang=pa.array(lang.astype(np.int32)),
                cell=pa.array(cell.astype(np.int32)), n=pa.array(table[lang, cell]),
            )

    return run


@dataclass
class Model:
    languages: list[str]
    cells: np.ndarray  # log-probability by language and cell
    allowed: np.ndarray  # by script and language
    key: str

    def scores(self, words: list[str]) -> np.ndarray:
        """By word and language; 0 for words without a letter."""
        own, sizes = grams(words)
        at = bounds(sizes)
        totals = np.concatenate((np.zeros((1, len(self.languages))), np.cumsum(self.cells.T[own], axis=0)))
        found = totals[at[1:]] - totals[at[:-1]]
        _, script = letters(words)
        found[script < 0] = 0
        real = script >= 0
        found[real] += np.where(self.allowed[script[real]], 0.0, OUT)
        return found


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limit: int = TRAIN_DOCS) -> Model:
    """Fits on about `limit` documents of each language; what comes to the driver is bounded by languages and cells."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang <> ''")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.empty((0, BUCKETS)), np.empty((len(SCRIPTS), 0), bool), "none")
    share = F.create_map(*(x for name in languages for x in (F.lit(name), F.lit(int((1 << 30) * min(1.0, limit / sizes[name]))))))
    rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")])
    counts = rows.select("text", "lang").mapInArrow(_counted(languages), "kind int, lang int, cell int, n long")
    table = counts.groupBy("kind", "lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    cells, scripts = np.full((len(languages), BUCKETS), ALPHA), np.zeros((len(languages), len(SCRIPTS)))
    own = table.kind.to_numpy() == 0
    cells[table.lang[own], table.cell[own]] += table.n[own]
    scripts[table.lang[~own], table.cell[~own]] += table.n[~own]
    allowed = (scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= RARE).T
    allowed[~allowed.any(axis=1)] = True  # a script seen nowhere tells nothing
    logs = np.log(cells / cells.sum(axis=1, keepdims=True))
    return Model(languages, logs, allowed, f"{hash(logs.tobytes())}")


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word of documents that lie one after the other, `sizes` words each.

    Documents of similar length go through the words side by side, so a step is one array operation for all of them.
    """
    n = scores.shape[1]
    label = np.zeros(len(scores), np.int64)
    starts = bounds(sizes)[:-1]
    classes = np.ceil(np.log2(np.maximum(sizes, 1)) * 2).astype(int)
    for own in (np.flatnonzero((classes == c) & (sizes > 0)) for c in np.unique(classes)):
        if not len(own):
            continue
        own = own[np.argsort(-sizes[own], kind="stable")]  # the longest first, so the active ones are a prefix
        size, start = sizes[own], starts[own]
        longest = int(size[0])
        active = np.searchsorted(-size, -np.arange(longest), side="left")  # documents with more words than each step
        # stay[t]: whether the best way to a label came from the same label; else it came from top[t]
        stay, top = np.ones((longest, len(own), n), bool), np.zeros((longest, len(own)), np.int16)
        value = scores[start].copy()
        for t in range(1, longest):
            k = active[t]
            past = value[:k]
            best = past.argmax(axis=1)
            jump = past[np.arange(k), best] - switch
            keep = past >= jump[:, None]
            stay[t, :k], top[t, :k] = keep, best
            value[:k] = np.where(keep, past, jump[:, None]) + scores[start[:k] + t]
        now = value.argmax(axis=1)
        for t in range(longest - 1, 0, -1):
            k = active[t]
            label[start[:k] + t] = now[:k]
            now[:k] = np.where(stay[t, np.arange(k), now[:k]], now[:k], top[t, :k])
        label[start] = now
    return label


class _Known:
    """Scores and letters of words seen before."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.scores = np.empty((1024, len(self.model.languages)), np.float32)
        self.letters = np.empty(1024, np.int32)

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.number) > WORDS:
            self.clear()
        fresh = list(set(words).difference(self.number))
        if fresh:
            at = len(self.number)
            while at + len(fresh) > len(self.letters):
                self.scores, self.letters = np.concatenate((self.scores, self.scores)), np.concatenate((self.letters, self.letters))
            for i in range(0, len(fresh), CHUNK):
                part = fresh[i : i + CHUNK]
                self.scores[at + i : at + i + len(part)] = self.model.scores(part)
                self.letters[at + i : at + i + len(part)] = letters(part)[0]
            self.number.update(zip(fresh, range(at, at + len(fresh))))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def _labelled(model: Model, switch: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Known = worker_cache("language", model.key, lambda: _Known(model))
        names = np.array([*model.languages, "und"])
        kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for ids, texts in blocks(batches, 6_000_000):  # long enough for many documents side by side
            words = [words_of(t) for t in texts]
            flat = [w for own in words for w in own]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            at = bounds(sizes)
            predicted, score, spans = [], [], []
            if model.languages and flat:
                rows = known.rows(flat)
                label, count = viterbi(known.scores[rows], sizes, switch), known.letters[rows]
                doc = np.repeat(np.arange(len(words)), sizes)
                n = len(model.languages)
                total = np.bincount(doc * n + label, count, len(words) * n).reshape(len(words), n)
            else:
                label, total = np.zeros(len(flat), np.int64), np.zeros((len(words), 1))
            change = np.flatnonzero(np.diff(label)) + 1
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                if not total[i].any():
                    predicted.append("und")
                    score.append(0.0)
                    spans.append([])
                    continue
                best = int(total[i].argmax())
                predicted.append(str(names[best]))
                score.append(float(total[i, best] / total[i].sum()))
                inner = change[np.searchsorted(change, a, "right") : np.searchsorted(change, b, "left")]
                edges = [a, *inner.tolist(), b]
                spans.append([{"lang": str(names[label[x]]), "start": x - a, "end": y - a} for x, y in zip(edges, edges[1:])])
            yield batch_of(
                doc_id=pa.array(ids, pa.int64()), lang_pred=pa.array(predicted, pa.string()),
                score=pa.array(score, pa.float64()), spans=pa.array(spans, kind),
            )

    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score, spans (ranges of words between blanks, ends exclusive)."""
    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang: string, start: int, end: int>>"
    return texts_of(docs, id_col, text_col).mapInArrow(_labelled(model, switch), schema)
