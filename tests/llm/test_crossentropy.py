import math
import random
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import crossentropy, queries


def plain(docs, wanted, fold, size):
    """Losses by counting in dictionaries, for small tables without shared cells."""
    tokens = {i: (t or "").encode().lower().split() for i, t in docs}
    counts = Counter(w for own in tokens.values() for w in own)
    words = sorted(counts, key=lambda w: (-counts[w], w))[:size]
    number = {w: k + 1 for k, w in enumerate(words)}
    as_numbers = {i: [number.get(w, 0) for w in own] for i, own in tokens.items()}
    out = {}
    for doc, own in as_numbers.items():
        losses = []
        for kind in ("target", "background"):
            used = [i for i in as_numbers if fold[i] != fold[doc] and (kind == "background" or i in wanted)]
            single = Counter(t for i in used for t in as_numbers[i])
            pairs = Counter(p for i in used for p in zip([-1, *as_numbers[i]], as_numbers[i]))
            n = sum(single.values())
            loss = 0.0
            for a, b in zip([-1, *own], own):
                even = (single[b] + 0.5) / (n + 0.5 * (len(words) + 1))
                seen = single[a] if a >= 0 else 0
                pair = min(pairs[a, b], seen, single[b])
                loss -= math.log((pair + 4 * even) / (seen + 4))
            losses.append(loss / max(len(own), 1))
        out[doc] = (len(own), *losses)
    return out


@pytest.mark.parametrize("size", [20, 1000])
def test_against_plain_counts(spark, size):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(vocabulary[: 10 + i % 30], k=rng.randrange(0, 60)))) for i in range(50)] + [(77, None), (78, "W1 w1 new")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = set(range(0, 50, 3))
    fold = {r[0]: r[1] for r in frame.selectExpr("doc_id", "pmod(xxhash64(doc_id), 2)").collect()}
    marks = spark.createDataFrame([(i,) for i in [*wanted, None, 999]], "doc_id long")
    want = plain(docs, wanted, fold, size)
    for r in crossentropy.score(frame, marks, size=size).collect():
        n, target, background = want[r.doc_id]
        assert r.n_tokens == n and np.isclose(r.ce_target, target, atol=1e-6) and np.isclose(r.ce_background, background, atol=1e-6)
        assert np.isclose(r.score, target - background, atol=1e-6)


def test_query_prefers_wanted_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op9_crossentropy"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    mean = {q: np.mean([r.score for r in rows if r.quality == q]) for q in (0, 1)}
    assert mean[1] < mean[0]


def test_edge_rows(spark):
    data = [(1, None), (None, "a b"), (2, ""), (3, "a b"), (3, "a b"), (4, "long " * 60_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as id", "true as wanted")
    marks = spark.createDataFrame([(3,), (3,), (None,)], "doc_id long")
    rows = crossentropy.score(docs, marks).collect()
    assert len(rows) == len(data)
    assert {r.doc_id: r.score for r in rows if not r.n_tokens} == {1: 0.0, 2: 0.0}
    assert crossentropy.score(docs, marks.filter("false")).filter("score is null or isnan(score)").count() == 0
    assert crossentropy.score(docs.filter("false"), marks).count() == 0


def test_counts_are_exact_for_large_vocabularies(spark, monkeypatch):
    """More words than any fixed vocabulary and more pairs than fixed cells, over several blocks and buckets."""
    monkeypatch.setattr(crossentropy, "BUCKET", 100_000)
    rng = random.Random(8)
    docs = [(i, " ".join(f"w{rng.randrange(60_000)}" for _ in range(10_000))) for i in range(40)] + [(1000, "w1 unheard w1"), (1001, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    wanted = set(range(0, 40, 4))
    fold = {r[0]: r[1] for r in frame.selectExpr("doc_id", "pmod(xxhash64(doc_id), 2)").collect()}
    counts = Counter(w for _, t in docs for w in (t or "").split())
    want = plain(docs, wanted, fold, sum(n >= crossentropy.LEAST for n in counts.values()))
    rows = crossentropy.score(frame, spark.createDataFrame([(i,) for i in wanted], "doc_id long")).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    for r in rows:
        assert r.n_tokens == want[r.doc_id][0] and np.allclose((r.ce_target, r.ce_background), want[r.doc_id][1:], atol=1e-6)
