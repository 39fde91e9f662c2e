"""Secrets by grammar inference.

The base rules (assign, access, hex) label credentials. From the labelled values of each kind a prefix tree with counts is
built, and states whose distributions agree are merged until none are left to merge: a state's chances of ending and of each
next character may differ by no more than a Hoeffding bound allows, here and in all states that follow. The result is a
probabilistic automaton of the kind's format. Others are inferred from ordinary runs of the same characters: words, numbers,
and runs of both. As runs of both may be credentials that no rule has labelled, those that look more like a credential than
like any other ordinary run are left out when the last one is inferred. Every run of at least eight such characters in every
text is a candidate; its likelihood under the automata of the credentials and of the ordinary runs, with their shares in all
texts, gives its probability of being a credential. Candidates above one half that touch no base span are added under their
likeliest kind. Base spans always stay.

The automata are fitted on at most TRAIN_VALUES different values per kind, those with the smallest hashes, so the driver
holds a bounded number of values; the shares are counted in all texts, and all texts are scored.

Rows: a null text counts as empty and has no span; a null doc_id is kept; repeated rows give equal results. Without any
labelled credential, or in an empty table, nothing is added to the base spans. Positions are code points, ends exclusive.
Texts of any length are scanned in linear time. Other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import nsmallest
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, forget, stored, texts_of

KINDS = ("assign", "access", "hex")
PLAIN = ("words", "numbers", "mixed")  # ordinary runs
TRAIN_VALUES = 2000  # different values an automaton is fitted on, at most
ALPHA = 0.01  # chance of keeping two states of one distribution apart
LEAST = 8  # characters of a candidate
SYMBOLS = ascii_letters + digits + "+/_.=-"
END = len(SYMBOLS)

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_KEYWORD = re.compile(r"(?i:passw|secret|token|api_?key)", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
_NUMBER = np.full(128, -1, np.int16)
_NUMBER[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(END)


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base rules, in order of start, then kind."""
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), 0, m.end(), m.group(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of runs without the dots and dashes around them, LEAST characters or more, that touch no base span."""
    out = []
    spans, i, done = base, 0, -1
    for m in _RUN.finditer(text):
        a, b = m.span()
        while i < len(spans) and spans[i][0] < b:
            done = max(done, spans[i][2])
            i += 1
        if done > a:
            continue
        value = m.group()
        if value[-1] in ".-" or value[0] in ".-":
            bare = value.lstrip(".-")
            a += len(value) - len(bare)
            value = bare.rstrip(".-")
            if len(value) < LEAST:
                continue
        out.append((a, a + len(value), value))
    return out


def plain_kind(value: str) -> str:
    if not _DIGIT.search(value):
        return "words"
    return "mixed" if _LETTER.search(value) else "numbers"


@dataclass
class Automaton:
    """Deterministic and probabilistic: next state and log chance per state and symbol, the last column is the end."""

    following: np.ndarray
    chance: np.ndarray

    def score(self, values: list[str]) -> np.ndarray:
        """Log likelihood of every value."""
        total = np.zeros(len(values))
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        order = np.argsort(-sizes, kind="stable")
        wide = sizes[order] > 64  # long ones by themselves, the rest position by position side by side
        for i in order[wide].tolist():
            total[i] = self._one(values[i])
        short = order[~wide]
        if len(short):
            sizes = sizes[short]
            chars = np.full((len(short), int(sizes[0])), END, np.int16)
            flat = _NUMBER[np.frombuffer("".join(values[i] for i in short.tolist()).encode(), np.uint8)]
            chars[np.arange(chars.shape[1]) < sizes[:, None]] = flat
            state = np.zeros(len(short), np.int64)
            found = np.zeros(len(short))
            for at in range(chars.shape[1]):
                n = int(np.searchsorted(-sizes, -at))  # values longer than `at` come first
                symbol = chars[:n, at]
                found[:n] += self.chance[state[:n], symbol]
                state[:n] = self.following[state[:n], symbol]
            total[short] = found + self.chance[state, END]
        return total

    def _one(self, value: str) -> float:
        following, chance = self.following.tolist(), self.chance.tolist()
        state, total = 0, 0.0
        for symbol in _NUMBER[np.frombuffer(value.encode(), np.uint8)].tolist():
            total += chance[state][symbol]
            state = following[state][symbol]
        return total + chance[state][END]


class Tree:
    """A prefix tree of values: per state its visits and ends, and by character the next state and how many went there."""

    def __init__(self, values: Iterable[str]):
        self.visits, self.ends, self.children, self.flow = [0], [0], [{}], [{}]
        for value in values:
            state = 0
            self.visits[0] += 1
            for c in value:
                after = self.children[state].get(c)
                if after is None:
                    after = self.children[state][c] = len(self.visits)
                    self.visits.append(0)
                    self.ends.append(0)
                    self.children.append({})
                    self.flow.append({})
                self.flow[state][c] = self.flow[state].get(c, 0) + 1
                state = after
                self.visits[state] += 1
            self.ends[state] += 1

    def agree(self, red: int, blue: int, limit: float) -> bool:
        """Whether both states, and all that follow them, may have the same chances."""
        pairs = [(red, blue)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.visits[a], self.visits[b]
            reach = limit * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if reach >= 1:  # too few values to tell anything apart, here and further on
                continue
            if abs(self.ends[a] / n - self.ends[b] / m) > reach:
                return False
            ours, theirs = self.flow[a], self.flow[b]
            for c, k in ours.items():
                j = theirs.get(c, 0)
                if abs(k / n - j / m) > reach:
                    return False
                if j:
                    pairs.append((self.children[a][c], self.children[b][c]))
            if any(j > reach * m for c, j in theirs.items() if c not in ours):
                return False
        return True

    def merge_loss(self, red: int, blue: int) -> float:
        """How much log likelihood the values lose if both states, and those that follow them, become one."""
        loss, pairs, log = 0.0, [(red, blue)], math.log
        while pairs:
            a, b = pairs.pop()
            n, m = self.visits[a], self.visits[b]
            ours, theirs = self.flow[a], self.flow[b]
            loss += (n + m) * log(n + m) - n * log(n) - m * log(m)
            for k, j in ((self.ends[a], self.ends[b]), *((ours.get(c, 0), j) for c, j in theirs.items())):
                if k and j:
                    loss += k * log(k) + j * log(j) - (k + j) * log(k + j)
            pairs += [(self.children[a][c], self.children[b][c]) for c in theirs if c in ours]
        return loss

    def fold(self, red: int, blue: int) -> None:
        """Add the tree below `blue` to the automaton at `red`."""
        pairs = [(red, blue)]
        while pairs:
            a, b = pairs.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, after in self.children[b].items():
                if c in self.children[a]:
                    pairs.append((self.children[a][c], after))
                else:
                    self.children[a][c] = after
                self.flow[a][c] = self.flow[a].get(c, 0) + self.flow[b][c]


def infer(values: Iterable[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of the values' format: every state is merged with the kept state that it agrees with best, or is kept."""
    tree = Tree(values)
    limit = math.sqrt(0.5 * math.log(2 / alpha))
    kept, members = [0], {0}
    while True:
        # the state most values come to, of those that follow a kept one
        rim = [(-tree.flow[r][c], r, c) for r in kept for c, s in tree.children[r].items() if s not in members]
        if not rim:
            break
        _, parent, symbol = min(rim)
        blue = tree.children[parent][symbol]
        like = [r for r in kept if tree.agree(r, blue, limit)]
        if like:
            red = like[0] if len(like) == 1 else min((tree.merge_loss(r, blue), r) for r in like)[1]
            tree.children[parent][symbol] = red
            tree.fold(red, blue)
        else:
            kept.append(blue)
            members.add(blue)
    place = {s: i for i, s in enumerate(kept)}
    # a character never seen in a state leads to one more state, in which all are equally likely
    following = np.full((len(kept) + 1, END + 1), len(kept), np.int32)
    counts = np.zeros((len(kept) + 1, END + 1))
    for s, i in place.items():
        counts[i, END] = tree.ends[s]
        for c, after in tree.children[s].items():
            following[i, SYMBOLS.index(c)] = place[after]
            counts[i, SYMBOLS.index(c)] = tree.flow[s][c]
    chance = (counts + 1 / (END + 1)) / (counts.sum(1, keepdims=True) + 1)
    return Automaton(following, np.log(chance))


def _gathered(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Of each kind, the values with the smallest hashes in a task, and the number of all."""
    held: dict[str, dict[str, int]] = {kind: {} for kind in KINDS + PLAIN}
    worst = dict.fromkeys(held, 2**64)
    n: Counter = Counter()
    for _, texts in blocks(batches):
        found: dict[str, Counter] = {kind: Counter() for kind in held}
        for raw in texts:
            text = (raw or b"").decode("utf-8")
            base = base_matches(text)
            for _, kind, _, value in base:
                found[KINDS[kind]][value] += 1
            for _, _, value in candidates(text, base):
                found[plain_kind(value)][value] += 1
        for kind, values in found.items():
            n[kind] += values.total()
            own = held[kind]
            own.update((v, h) for v in values if (h := xxhash.xxh64_intdigest(v)) < worst[kind])
            if len(own) > limit:
                held[kind] = dict(nsmallest(limit, own.items(), key=lambda x: (x[1], x[0])))
                worst[kind] = max(held[kind].values()) + 1
    for kind, own in held.items():
        order = sorted(own)
        yield batch_of(
            kind=pa.array([kind] * (len(order) + 1)), value=pa.array([None, *order], pa.string()),
            # as signed numbers in the same order
            hash=pa.array([None, *(own[v] - 2**63 for v in order)], pa.int64()), n=pa.array([n[kind]] + [0] * len(order), pa.int64()),
        )


@dataclass
class Model:
    """Per kind an automaton and the log of its share of all runs; the credentials' kinds come first."""

    kinds: list[str]
    automata: list[Automaton]
    shares: list[float]

    def odds(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per value, its probability of being a credential, and the number of the likeliest kind."""
        n = sum(kind in KINDS for kind in self.kinds)
        if not n or not values:
            return np.zeros(len(values)), np.zeros(len(values), np.int64)
        if n == len(self.kinds):
            plain = np.full(len(values), -np.inf)
        likely = np.stack([a.score(values) + share for a, share in zip(self.automata, self.shares)])
        if n < len(self.kinds):
            plain = np.logaddexp.reduce(likely[n:], axis=0)
        gap = plain - np.logaddexp.reduce(likely[:n], axis=0)
        return 1 / (1 + np.exp(np.clip(gap, -700, 700))), likely[:n].argmax(0)


def fit(values: dict[str, list[str]], total: dict[str, int]) -> Model:
    """The automata of bounded lists of values; `total` says how often each kind occurs in all texts."""
    runs = sum(total.values())
    kinds = [kind for kind in KINDS + PLAIN if values.get(kind)]
    share = {kind: math.log(total[kind] / runs) for kind in kinds}
    automata = {kind: infer(values[kind]) for kind in kinds if kind != "mixed"}
    if "mixed" in kinds:
        every = infer(sorted(v for kind in PLAIN for v in values.get(kind, [])[:500]))  # ordinary runs of any kind, to begin with
        others = [kind for kind in kinds if kind != "mixed"]
        first = Model([*others, "mixed"], [*(automata[k] for k in others), every], [*(share[k] for k in others), share["mixed"]])
        ordinary = [v for v, p in zip(values["mixed"], first.odds(values["mixed"])[0]) if p <= 0.5]
        if ordinary:
            automata["mixed"] = infer(ordinary)
            share["mixed"] += math.log(len(ordinary) / len(values["mixed"]))
        else:
            automata["mixed"] = every
    return Model(kinds, [automata[kind] for kind in kinds], [share[kind] for kind in kinds])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_VALUES) -> Model:
    """The model of the labelled kinds that occur, and of the ordinary runs."""
    schema = "kind string, value string, hash long, n long"
    rows = stored(texts_of(docs, id_col, text_col).mapInArrow(lambda batches: _gathered(batches, limit), schema), "values")
    total = dict(rows.groupBy("kind").agg(F.sum("n").alias("n")).collect())
    # every task gives at most `limit` values of a kind, so what is sorted here does not grow with the texts of a task
    found = rows.filter("value IS NOT NULL").select("kind", "value", "hash").distinct()
    values = {kind: [r.value for r in found.filter(F.col("kind") == kind).orderBy("hash", "value").limit(limit).collect()] for kind in KINDS + PLAIN}
    forget(rows)
    return fit(values, total)


_SPANS = "array<struct<kind: string, start: long, end: long, base: boolean, score: double>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])


def _found(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[float, int]] = {}  # judged once a task, and again when it was forgotten
        for ids, texts in blocks(batches):
            plain = [(t or b"").decode("utf-8") for t in texts]
            base = [base_matches(t) for t in plain]
            more = [candidates(t, b) for t, b in zip(plain, base)]
            if len(known) > 300_000:
                known.clear()
            values = {v for own in more for _, _, v in own}
            values.update(v for own in base for _, _, _, v in own)
            new = [v for v in values if v not in known]
            known.update(zip(new, zip(*(x.tolist() for x in model.odds(new)))))
            rows = []
            for own, further in zip(base, more):
                spans = [(a, kind, b, True, known[v][0]) for a, kind, b, v in own]
                for a, b, v in further:
                    p, kind = known[v]
                    if p > 0.5:
                        spans.append((a, KINDS.index(model.kinds[kind]), b, False, p))
                rows.append([{"kind": KINDS[k], "start": a, "end": b, "base": s, "score": p} for a, k, b, s, p in sorted(spans)])
            yield batch_of(doc_id=pa.array(ids, pa.int64()), spans=pa.array(rows, pa.list_(_SPAN)))

    return run


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end, whether by the base rules, probability) in order of start, then of KINDS."""
    return texts_of(docs, id_col, text_col).mapInArrow(_found(model), f"doc_id long, spans {_SPANS}")
