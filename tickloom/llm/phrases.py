"""Substring dedup by repeated-phrase automata.

A window is SPAN consecutive words. Every word covered by a window that also starts in a document with a smaller id is
removed. The windows of all documents are never shuffled; the steps are:

1. Each window gets a key, the smallest hash among its runs of GRAM words. Equal windows have equal keys, and neighbouring
   windows mostly share theirs, so a document becomes a short list of (key, windows in a row). A key found in two
   documents is recurring; all other windows are done with.
2. The stretches of words under recurring keys are cut out; equal ones collapse. Their windows are counted by hash: a
   window of two documents is a confirmed phrase, owned by the smallest id.
3. The phrases are dealt to shards by key, a bounded number to each. A shard compiles them to an Aho-Corasick automaton
   whose letters are words, and all stretches with the shard's keys stream through it, which locates every occurrence,
   word by word and whatever the hashes said: the automaton finds the words of the key, and the phrases around them are
   compared there; a key with many phrases has each of their windows as a pattern. A key of very many documents is spread over several shards, its phrases
   copied to each of them, its stretches dealt out.
4. Occurrences owned by a smaller id are joined back to their documents.

Texts are shuffled twice, once to cut out stretches and once to remove words. Where a third of all documents are copies
their stretches collapse in step 2 before anything is compared.

Rows: a null or empty text has no words; a null doc_id counts as larger than every other; rows that are equal in doc_id and
text get equal results, and rows with one id are never compared with each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, bounds, forget, gather, stored, texts_of, worker_cache

SPAN, GRAM = 50, 12
STRETCH = 64  # windows of one stretch at most; longer ones are cut
SHARD_PHRASES = 100_000  # windows of a shard's phrases on average: about half a million words
LETTERS = 1_000_000  # different words of one automaton
SEEDS = 32  # phrases of one key that are compared one by one where the key's words are found
KEY_DOCS = 50_000  # documents of a key that go to one shard
LAST = (1 << 63) - 1  # stands for a null id
_BASE = 0x9E3779B97F4A7C15


_VALUES = np.random.default_rng(50).integers(0, 1 << 63, 256).astype(np.uint64)  # one number per byte
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True


def _powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; at least n of them."""
    size = 1 << max(n, 1 << 16).bit_length()

    def make() -> np.ndarray:
        found = np.full(size, base, np.uint64)
        found[0] = 1
        return np.multiply.accumulate(found)

    return worker_cache("phrases", f"powers {base} {size}", make)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n values, from those of half as many."""
    whole, size, done = None, 1, 0
    part = hashes
    while True:
        if n & size:
            if whole is None:
                whole = part
            else:
                rest = len(hashes) - done - size + 1
                whole = whole[:rest] * _power(size) + part[done : done + rest]
            done += size
        if done == n:
            break
        part = part[: len(part) - size] * _power(size) + part[size:]
        size *= 2
    whole = (whole ^ (whole >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return whole ^ (whole >> np.uint64(29))


def smallest(values: np.ndarray, n: int) -> np.ndarray:
    """The minimum of each run of n values."""
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    more = n - size
    return np.minimum(values[: len(values) - more], values[more:]) if more else values


def hashes_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, a polynomial in its bytes, and where the words start."""
    data = np.frombuffer(text, np.uint8)
    blank = np.concatenate(([True], _BLANK[data], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * _powers(_BASE, len(data))[: len(data)])))
    found = (sums[ends] - sums[starts]) * _powers(pow(_BASE, -1, 1 << 64), len(data))[starts]
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(31)), starts


def keyed_runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window and number of windows of each run of windows with one key."""
    hashes, _ = hashes_of(text)
    if len(hashes) < SPAN:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    keys = smallest(rolling(hashes, GRAM), SPAN - GRAM + 1)
    fresh = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((fresh, [len(keys)])))
    cuts = -(-sizes // STRETCH)
    start = np.repeat(fresh, cuts) + (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * STRETCH
    n = np.minimum(np.repeat(fresh + sizes, cuts) - start, STRETCH)
    return keys[start].view(np.int64), start.astype(np.int32), n.astype(np.int32)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _mark(text: bytes | None) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text or b"", 42)).astype(np.int64))


def _own(ids: list) -> list[int]:
    return [LAST if i is None else i for i in ids]


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in blocks(batches):
        words = [(t or b"").split() for t in texts]
        found = [keyed_runs(t or b"") for t in texts]
        yield batch_of(
            doc_id=pa.array(ids, pa.int64()),
            own=pa.array(_own(ids), pa.int64()),
            mark=pa.array([_mark(t) for t in texts], pa.int64()),
            n_words=pa.array([len(w) for w in words], pa.int64()),
            sha=pa.array([_digest(w) for w in words]),
            keys=pa.array([f[0] for f in found], pa.list_(pa.int64())),
            starts=pa.array([f[1] for f in found], pa.list_(pa.int32())),
            sizes=pa.array([f[2] for f in found], pa.list_(pa.int32())),
        )


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each wanted run; the text only where this task has not sent it before."""
    sent: set[int] = set()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        own, mark, runs = (batch.column(c).to_pylist() for c in ("own", "mark", "runs"))
        rows: list[tuple] = []
        for i in range(len(own)):
            words = texts[i].as_py().split()
            for run in runs[i]:
                text = b" ".join(words[run["start"] : run["start"] + run["size"] + SPAN - 1])
                seg = xxhash.xxh64_intdigest(text) >> 1
                fresh = seg not in sent
                sent.add(seg)
                rows.append((own[i], mark[i], run["key"], run["cuts"], run["start"], seg, text if fresh else None))
            if len(sent) > 500_000:
                sent.clear()
            if len(rows) > 20_000 or i == len(own) - 1:
                names = ("own", "mark", "key", "cuts", "start", "seg", "text")
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
                yield batch_of(**{n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(zip(names, kinds))})
                rows = []


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash, place (stretch number and window in one number), smallest and largest document of each window."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        hashes, starts = hashes_of(b"\n".join(texts))
        windows = rolling(hashes, SPAN)
        first_word = np.searchsorted(starts, bounds(len(t) + 1 for t in texts))
        sizes = np.diff(first_word) - SPAN + 1
        number, first, last = (batch.column(c).to_numpy() for c in ("number", "first", "last"))
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield batch_of(
            window=pa.array(gather(windows, first_word[:-1], sizes).view(np.int64)),
            place=pa.array(np.repeat(number, sizes) * STRETCH + place),
            first=pa.array(np.repeat(first, sizes)),
            last=pa.array(np.repeat(last, sizes)),
        )


class Shard:
    """Phrases as automata whose letters are words; a new automaton begins when the letters run out.

    All phrases of one key contain the key's GRAM words. An automaton finds these and the phrases are compared there. Where
    a key has more than SEEDS of them, each of their windows is a pattern of its own instead.
    """

    def __init__(self) -> None:
        self.phrases: dict[int, list[tuple[bytes, list[tuple[int, int]]]]] = {}
        self.parts: list[tuple[dict[bytes, str], ahocorasick.Automaton]] | None = None

    def add(self, key: int, text: bytes, places: list[tuple[int, int]]) -> None:
        """places: (window, owner) in the words of the text."""
        self.phrases.setdefault(key, []).append((text, places))

    def compile(self) -> None:
        self.parts = []
        for key, phrases in self.phrases.items():
            seeds: dict[str, list] = {}
            for text, places in phrases:
                words = text.split()
                if not self.parts or len(self.parts[-1][0]) + len(words) > LETTERS:
                    self._seeded(key, seeds)
                    seeds = {}
                    self.parts.append(({}, ahocorasick.Automaton()))
                letters, automaton = self.parts[-1]
                for word in words:
                    if word not in letters:
                        code = len(letters) + 1
                        letters[word] = chr(code if code < 0xD800 else code + 0x800)  # past the surrogates
                spelled = "".join([letters[w] for w in words])
                if len(phrases) > SEEDS:
                    for at, owner in places:
                        automaton.add_word(spelled[at : at + SPAN], owner)
                else:
                    found = np.flatnonzero(rolling(hashes_of(text)[0], GRAM).view(np.int64) == key).tolist()
                    for at in found:
                        seeds.setdefault(spelled[at : at + GRAM], []).append((at, spelled, places))
            self._seeded(key, seeds)
        for _, automaton in self.parts:
            automaton.make_automaton()

    def _seeded(self, key: int, seeds: dict[str, list]) -> None:
        for gram, found in seeds.items():
            automaton = self.parts[-1][1]
            automaton.add_word(gram, automaton.get(gram, []) + [(key, found)])

    def locate(self, key: int, text: bytes) -> list[tuple[int, int]]:
        """(window, owner) of each occurrence of a phrase's window in the words of the text."""
        if key not in self.phrases:
            return []
        if self.parts is None:
            self.compile()
        words = text.split()
        out: set[tuple[int, int]] = set()
        for letters, automaton in self.parts:
            spelled = "".join([letters.get(w, "\0") for w in words])
            tried = set()
            for end, value in automaton.iter(spelled):
                if isinstance(value, int):
                    out.add((end - SPAN + 1, value))
                    continue
                for own, found in value:
                    for at, phrase, places in found if own == key else ():
                        shift = end - GRAM + 1 - at
                        if (shift, id(places)) not in tried:
                            tried.add((shift, id(places)))
                            for w, owner in places:
                                if w + shift >= 0 and phrase[w : w + SPAN] == spelled[w + shift : w + shift + SPAN]:
                                    out.add((w + shift, owner))
        return sorted(out)


def _locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, now = Shard(), None
    for batch in batches:
        number, key, seg, of = (batch.column(c).to_pylist() for c in ("shard", "key", "seg", "places"))
        rows = []
        for i, text in enumerate(batch.column("text")):
            if number[i] != now:
                shard, now = Shard(), number[i]
            if of[i] is not None:
                shard.add(key[i], text.as_py(), [(p["at"], p["owner"]) for p in of[i]])
            elif hits := shard.locate(key[i], text.as_py()):
                rows.append((key[i], seg[i], [{"at": a, "owner": o} for a, o in hits]))
        kind = pa.list_(pa.struct([("at", pa.int32()), ("owner", pa.int64())]))
        yield batch_of(
            key=pa.array([r[0] for r in rows], pa.int64()), seg=pa.array([r[1] for r in rows], pa.int64()),
            hits=pa.array([r[2] for r in rows], kind),
        )


def removed(n: int, windows: np.ndarray) -> np.ndarray:
    """True for each of n words that a window starting at one of the given places covers."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, windows, 1)
    np.add.at(change, np.minimum(windows + SPAN, n), -1)
    return np.cumsum(change[:n]) > 0


def _without(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        out, shas = [], []
        for i, windows in enumerate(batch.column("windows")):
            words = texts[i].as_py().split()
            gone = removed(len(words), np.array(windows.as_py(), np.int64))
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
            out.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
            shas.append(_digest([w for w, x in zip(words, gone.tolist()) if not x]))
        yield batch_of(
            own=batch.column("own"), mark=batch.column("mark"),
            ranges=pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), kept_sha=pa.array(shas),
        )


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, ranges of removed words (ends exclusive), sha256 of the words kept."""
    texts = texts_of(docs, id_col, text_col)
    schema = "doc_id long, own long, mark long, n_words long, sha string, keys array<long>, starts array<int>, sizes array<int>"
    rows = stored(texts.mapInArrow(_runs, schema), "runs")
    runs = rows.select("own", "mark", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("starts").alias("start"), F.col("sizes").alias("size"))))
    runs = runs.toDF("own", "mark", "key", "start", "size")
    known = runs.groupBy("key").agg(F.min("own").alias("first"), F.max("own").alias("last"), F.count(F.lit(1)).alias("n"))
    recurring = known.filter("first < last").select("key", (F.col("n") / KEY_DOCS + 1).cast("int").alias("cuts"))
    wanted = runs.join(recurring, "key").groupBy("own", "mark").agg(F.collect_set(F.struct("key", "cuts", "start", "size")).alias("runs"))

    marked = texts.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("own"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), "text"
    )
    cut = marked.join(wanted, ["own", "mark"])
    schema = "own long, mark long, key long, cuts int, start int, seg long, text binary"
    places = stored(cut.mapInArrow(_stretches, schema), "stretches")
    distinct = places.groupBy("key", "seg").agg(
        F.max("text").alias("text"), F.max("cuts").alias("cuts"), F.min("own").alias("first"), F.max("own").alias("last")
    )
    distinct = stored(distinct.withColumn("number", F.monotonically_increasing_id()), "distinct")
    found = stored(places.select("own", "mark", "key", "seg", "start"), "places")
    forget(places)

    windows = distinct.select("number", "text", "first", "last").mapInArrow(_windows, "window long, place long, first long, last long")
    confirmed = windows.groupBy("window").agg(F.min("first").alias("owner"), F.max("last").alias("last"), F.min("place").alias("place"))
    confirmed = stored(confirmed.filter("owner < last").select("owner", "place"), "phrases")
    shards = confirmed.count() // SHARD_PHRASES + 64
    phrases = confirmed.select(
        F.floor(F.col("place") / STRETCH).alias("number"),
        F.struct(F.pmod("place", F.lit(STRETCH)).cast("int").alias("at"), "owner").alias("place"),
    )
    phrases = phrases.groupBy("number").agg(F.collect_list("place").alias("places")).join(distinct, "number")
    phrases = phrases.select("key", "seg", "text", "places", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    searched = distinct.select("key", "seg", "text", F.lit(None).cast("array<struct<at: int, owner: long>>").alias("places"), F.pmod("number", "cuts").cast("int").alias("cut"))
    both = phrases.unionByName(searched).withColumn("shard", F.pmod(F.xxhash64("key", "cut"), F.lit(shards)))
    both = both.withColumn("later", F.col("places").isNull()).repartition("shard").sortWithinPartitions("shard", "later")
    located = stored(both.select("shard", "key", "seg", "text", "places").mapInArrow(_locate, "key long, seg long, hits array<struct<at: int, owner: long>>"), "located")

    forget(distinct, confirmed)
    hits = found.join(located, ["key", "seg"])
    mine = F.filter("hits", lambda h: h.owner < F.col("own"))
    hits = hits.select("own", "mark", F.transform(mine, lambda h: F.col("start") + h.at).alias("windows")).filter(F.size("windows") > 0)
    hits = hits.groupBy("own", "mark").agg(F.flatten(F.collect_set("windows")).alias("windows"))
    changed = marked.join(hits, ["own", "mark"]).mapInArrow(
        _without, "own long, mark long, ranges array<struct<start: long, end: long>>, kept_sha string"
    ).dropDuplicates(["own", "mark"])
    return rows.select("doc_id", "own", "mark", "n_words", "sha").join(changed, ["own", "mark"], "left").select(
        "doc_id", "n_words", F.coalesce("ranges", F.array()).alias("ranges"), F.coalesce("kept_sha", "sha").alias("kept_sha256")
    )
