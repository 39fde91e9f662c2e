"""Personal data by weak supervision.

Candidates are the base matches (email, ip, card, phone by fixed rules), looser forms of the same kinds, and two kinds
without a base rule: tokens (long runs of letters and digits) and bank account numbers. Labelers vote for (+1), against
(-1) or not at all (0) on each: the strict rule, a checksum or range, a gazetteer, the words before, and the edges. Votes
are counted per pattern over all texts; patterns are few (at most kinds x 3^5 x lengths), so their counts come to the
driver, where expectation-maximisation estimates how reliable each labeler is and how probable each pattern is.

The final span classifier learns these probabilities from what the labelers do not see as well: the form of the span, its
beginning and length, and the words and characters around it, hashed to CELLS features of a logistic model. It is fitted on
at most TRAIN_SPANS candidates, those with the smallest hashes, so copies of a span with its surroundings count once. A
loose candidate is added when the classifier accepts it and it overlaps no span already there; base spans always stay.

Rows: a null text counts as empty and has no span; a null doc_id is kept; repeated rows give equal results. An empty table
gives an empty result. Positions are code points, ends exclusive. All scans are linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import nsmallest
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, blocks, forget, stored, texts_of

KINDS = ("email", "ip", "card", "phone")  # with a base rule
ALL_KINDS = (*KINDS, "token", "account")
TRAIN_SPANS = 20_000  # candidates the classifier is fitted on, at most
CELLS = 1 << 13
LABELERS = ("rule", "range", "gazetteer", "context", "edges")

# base rules
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
# looser forms
_SPELT = re.compile(r"(?<![\w.])\w[\w.+-]{0,63} ?(?:\(at\)|\[at\]| at ) ?\w[\w-]{0,62}(?: ?(?:\(dot\)|\[dot\]| dot ) ?\w{2,20}){1,4}", re.I)
_LOCAL_PHONE = re.compile(r"(?<![\w+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])")
_LONG_IP = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}")
_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")

# gazetteers and context words
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io de fr es it uk eu ch at nl be pl se us ca au jp cn in br ru".split())
FOR = {
    "email": frozenset("mail email e-mail contact write address adresse correo courriel".split()),
    "ip": frozenset("ip host server address login from client node".split()),
    "card": frozenset("card credit visa mastercard amex debit pay payment karte carte tarjeta".split()),
    "phone": frozenset("call phone tel telephone mobile fax cell dial telefon teléfono téléphone".split()),
    "token": frozenset("token secret password passwd key apikey api_key auth authorization bearer credential credentials".split()),
    "account": frozenset("iban account bank konto cuenta compte transfer überweisung".split()),
}
AGAINST = frozenset("version build release isbn issn sku order invoice ticket serial item page revision id commit checksum digest md5 sha1 sha256".split())
# how tokens of well-known services begin, and the countries' signs that account numbers begin with (fixed values)
TOKEN_STARTS = ("AKIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "sk_test_", "sk-", "xoxb-", "xoxp-", "AIza", "eyJ")
COUNTRIES = frozenset(
    "AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GI GR HR HU IE IL IS IT LI LT LU LV MC MT NL NO PL PT RO SA SE SI SK SM TR".split()
)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _account_check(text: str) -> bool:
    """Whether the number, its first four signs moved to the end and letters counted from 10, leaves 1 when divided by 97."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without rescanning: each @ takes the local characters before it, back to the previous match."""
    done, at = 0, text.find("@")
    while at >= 0:
        size, reach = 0, 64
        while True:  # look back in growing steps, so that a long run of local characters is read about twice
            tail = text[max(done, at - reach) : at]
            size = len(tail) - len(tail.rstrip(_LOCAL))
            if size < len(tail) or len(tail) < reach:
                break
            reach *= 2
        host = _HOST.match(text, at + 1) if size else None
        if host:
            yield at - size, host.end()
            done = host.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order of start, then kind."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
                spans.append((m.start(), 2, m.end()))
        spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(spans)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that overlap no base span."""
    found = []
    low = text.lower() if "dot" in text or "DOT" in text or "Dot" in text else ""
    if any(s in low for s in (" dot ", "(dot)", "[dot]")):
        found += [(m.start(), 0, m.end()) for m in _SPELT.finditer(text)]
    if text.count(":") >= 7:
        found += [(m.start(), 1, m.end()) for m in _LONG_IP.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 13 <= m.end() - m.start() <= 40 and 13 <= len(_digits(m.group())) <= 19]
        found += [(m.start(), 3, m.end()) for m in _LOCAL_PHONE.finditer(text)]
        found += [(m.start(), 4, m.end()) for m in _TOKEN.finditer(text)]
        found += [(m.start(), 5, m.end()) for m in _ACCOUNT.finditer(text)]
    starts, ends = [], []  # the base spans as disjoint stretches
    for a, _, b in base:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out: list[tuple[int, int, int]] = []
    for a, kind, b in sorted(found):
        i = bisect_right(ends, a)  # the first stretch that ends behind a
        if (i == len(ends) or starts[i] >= b) and (not out or out[-1][2] <= a):
            out.append((a, kind, b))
    return out


def votes(text: str, start: int, kind: int, end: int, strict: bool) -> tuple[int, ...]:
    """(kind, one vote per labeler, length class)."""
    span, digits = text[start:end], _digits(text[start:end])
    if kind == 0:
        ranged = 1 if 6 <= len(span) <= 254 and ".." not in span else -1
        known = 1 if re.split(r"[^0-9a-z]+", span.lower())[-1] in TOP_DOMAINS else -1
    elif kind == 1:
        ranged = 1
        known = -1 if span.startswith(("0.", "255.")) else 1
    elif kind == 2:
        ranged = 1 if _luhn(digits) else -1
        known = 1 if digits[0] in "3456" else -1
    elif kind == 3:
        ranged = 1 if 10 <= len(digits) <= 15 else -1
        known = 1 if digits.lstrip("1")[:1] not in ("", "0") else -1
    elif kind == 4:
        mixed = 0.15 <= len(digits) / len(span) <= 0.85  # words joined by dashes have fewer digits
        ranged = 1 if 24 <= len(span) <= 512 and len(set(span)) >= 10 and mixed else -1
        known = 1 if span.startswith(TOKEN_STARTS) else 0  # many plain hex numbers are no secrets
    else:
        ranged = 1 if 15 <= len(span.replace(" ", "")) <= 34 and _account_check(span) else -1
        known = 1 if span[:2] in COUNTRIES else -1
    before = [w.strip(".,:;()[]\"'").lower() for w in text[max(0, start - 40) : start].split()[-4:]]
    context = 1 if FOR[ALL_KINDS[kind]].intersection(before) else -1 if AGAINST.intersection(before) else 0
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    edges = -1 if any(c.isalnum() or c in "_-=/" for c in around) else 1
    return kind, 1 if strict else 0, ranged, known, context, edges, min(len(span) // 8, 4)


def _words_at(text: str) -> list[str]:
    return [re.sub("[0-9]", "0", w.strip(".,:;()[]=\"'").lower()) for w in text.split()]


def cells(text: str, start: int, end: int, pattern: tuple[int, ...]) -> list[int]:
    """The features of a candidate: its votes, its form, and what stands around it."""
    kind, span = ALL_KINDS[pattern[0]], text[start:end]
    form = re.sub("0+", "0", re.sub("A+", "A", re.sub("a+", "a", re.sub("[0-9]", "0", re.sub("[A-Z]", "A", re.sub("[^0-9A-Z\\W_]", "a", span))))))
    before, after = _words_at(text[max(0, start - 40) : start])[-2:], _words_at(text[end : end + 30])[:1]
    names = [
        "kind", *(f"vote {j} {v}" for j, v in enumerate(pattern[1:-1])), f"length {min(len(span) // 4, 12)}", f"form {form[:12]}",
        f"begins {form[:1]}{span[:2]}", f"left {text[start - 1 : start] if start else ''}", f"right {text[end : end + 1]}",
        *(f"before {w}" for w in before), *(f"after {w}" for w in after),
    ]
    return sorted({crc32(f"{kind} {name}".encode()) % CELLS for name in names})


def _patterns(limit: int):
    """Counts of patterns (without hash), and the candidates with the smallest hashes of a task with their cells."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        held: dict[int, tuple] = {}
        worst = 2**63
        for _, texts in blocks(batches):
            for raw in texts:
                text = (raw or b"").decode("utf-8")
                base = base_spans(text)
                for strict, spans in ((True, base), (False, loose_spans(text, base))):
                    for a, kind, b in spans:
                        pattern = votes(text, a, kind, b, strict)
                        counts[pattern] += 1
                        near = f"{kind} {text[max(0, a - 40) : b + 30]}"
                        if (h := xxhash.xxh64_intdigest(near) >> 1) < worst:
                            held[h] = (pattern, cells(text, a, b, pattern))
            if len(held) > 2 * limit:
                held = {h: held[h] for h in nsmallest(limit, held)}
                worst = max(held)
        order = sorted(held)
        yield batch_of(
            pattern=pa.array([list(p) for p in counts] + [list(held[h][0]) for h in order], pa.list_(pa.int32())),
            n=pa.array([*counts.values(), *[0] * len(order)], pa.int64()),
            hash=pa.array([*[None] * len(counts), *order], pa.int64()),
            cells=pa.array([*[None] * len(counts), *(held[h][1] for h in order)], pa.list_(pa.int32())),
        )

    return run


def reliabilities(patterns: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: the chance of each vote of each labeler given no / yes, and each pattern's probability of yes.

    patterns: (kind, votes..., length class) per row, n its count. A labeler's abstaining says nothing.
    """
    cast = patterns[:, 1:-1]
    kind = patterns[:, 0]
    yes = np.clip(0.5 + 0.15 * cast.sum(axis=1), 0.05, 0.95)
    chance = np.full((2, cast.shape[1], 2), 0.5)  # given no / yes, labeler, vote against / for
    for _ in range(rounds):
        for truth, weight in ((0, n * (1 - yes)), (1, n * yes)):
            for j in range(cast.shape[1]):
                # a few made-up counts keep every labeler better than chance and no probability at 0
                against = weight[cast[:, j] < 0].sum() + (4 if truth == 0 else 1)
                favour = weight[cast[:, j] > 0].sum() + (4 if truth == 1 else 1)
                chance[truth, j] = np.array([against, favour]) / (against + favour)
        odds = np.zeros(len(n))
        for k in np.unique(kind):
            own = kind == k
            share = (1 + (n * yes)[own].sum()) / (2 + n[own].sum())
            odds[own] = np.log(share / (1 - share))
        for j in range(cast.shape[1]):
            ratio = np.log(chance[1, j] / chance[0, j])
            odds += np.where(cast[:, j] < 0, ratio[0], np.where(cast[:, j] > 0, ratio[1], 0.0))
        yes = 1 / (1 + np.exp(-odds))
    return chance, yes


def fit(examples: list[list[int]], wanted: np.ndarray, rounds: int = 300, shrink: float = 1e-3) -> np.ndarray:
    """Weights of a logistic model that gives each example, a list of cells, its wanted probability; ridge-penalised."""
    weights, step = np.zeros(CELLS), np.zeros(CELLS)
    if not examples:
        return weights
    row = np.repeat(np.arange(len(examples)), [len(c) for c in examples])
    cell = np.concatenate([np.asarray(c, np.int64) for c in examples])
    often = np.bincount(cell, minlength=CELLS)
    pace = 4 / (np.bincount(row).max() * np.maximum(often, 1))  # no step goes too far, however often a cell is found
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.bincount(row, weights[cell], len(examples))))
        slope = np.bincount(cell, (p - wanted)[row], CELLS) + shrink * often * weights
        step = 0.9 * step - pace * slope
        weights += 0.1 * step
    return weights


@dataclass
class Model:
    weights: np.ndarray
    chance: np.ndarray

    def probability(self, own: list[int]) -> float:
        """Of a candidate with these cells."""
        return float(1 / (1 + np.exp(-self.weights[own].sum())))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_SPANS) -> Model:
    """Votes on every candidate of every text, counted by pattern; these and a bounded number of candidates come to the driver."""
    schema = "pattern array<int>, n long, hash long, cells array<int>"
    found = stored(texts_of(docs, id_col, text_col).mapInArrow(_patterns(limit), schema), "votes")
    rows = found.filter("hash IS NULL").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    sample = found.filter("hash IS NOT NULL").dropDuplicates(["hash"]).orderBy("hash").limit(limit).collect()
    forget(found)
    if not rows:
        return Model(np.zeros(CELLS), np.full((2, len(LABELERS), 2), 0.5))
    rows = sorted((tuple(r.pattern), r.n) for r in rows)
    patterns, n = np.array([p for p, _ in rows]), np.array([c for _, c in rows], float)
    chance, yes = reliabilities(patterns, n)
    probable = {p: y for (p, _), y in zip(rows, yes.tolist())}
    return Model(fit([r.cells for r in sample], np.array([probable[tuple(r.pattern)] for r in sample])), chance)


def spans_of(text: str, model: Model) -> list[tuple[int, int, int, bool, float]]:
    """(start, kind, end, whether by the base rules, probability), in order."""
    base, out = base_spans(text), []
    for strict, spans in ((True, base), (False, loose_spans(text, base))):
        for a, k, b in spans:
            p = model.probability(cells(text, a, b, votes(text, a, k, b, strict)))
            if strict or p > 0.5:
                out.append((a, k, b, strict, p))
    return sorted(out)


_SPANS = "array<struct<kind: string, start: long, end: long, base: boolean, score: double>>"


def _found(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])
        )
        for ids, texts in blocks(batches):
            found = [spans_of((t or b"").decode("utf-8"), model) for t in texts]
            rows = [[{"kind": ALL_KINDS[k], "start": a, "end": b, "base": s, "score": p} for a, k, b, s, p in own] for own in found]
            yield batch_of(doc_id=pa.array(ids, pa.int64()), spans=pa.array(rows, kind))

    return run


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans in order of start, then of ALL_KINDS."""
    return texts_of(docs, id_col, text_col).mapInArrow(_found(model), f"doc_id long, spans {_SPANS}")


def mask(text: str, model: Model) -> str:
    """The text with [KIND] in place of each span; of overlapping ones the first names the whole stretch."""
    out, done, stretch = [], 0, None
    for a, k, b, _, _ in [*spans_of(text, model), (len(text), -1, len(text), True, 0.0)]:
        if stretch and a < stretch[2]:
            stretch = (stretch[0], stretch[1], max(stretch[2], b))
            continue
        if stretch:
            out += [text[done : stretch[0]], f"[{ALL_KINDS[stretch[1]].upper()}]"]
            done = stretch[2]
        stretch = (a, k, b)
    return "".join([*out, text[done:]])


def masked(docs: DataFrame, model: Model, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The rows of `docs` with spans masked in their texts and the number of code points put right; nulls stay null."""
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (t := v.as_py()) is None else mask(t, model) for v in batch.column(place)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    out = docs.mapInArrow(run, docs.schema)
    if size_col in docs.columns:
        out = out.withColumn(size_col, F.coalesce(F.length(text_col), F.col(size_col)).cast(docs.schema[size_col].dataType))
    return out
