import hashlib
import random
import re

import numpy as np
import pytest
from compare import database, difference

from tickloom.llm import phrases, queries


def plain(docs):
    """doc -> (words, removed, sha256), by a table of all windows."""
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        for k in range(len(w) - 49):
            window = tuple(w[k : k + 50])
            first[window] = min(first.get(window, i), i)
    out = {}
    for i, w in words:
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def got(rows):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}


def test_query_against_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op1_phrases"
    assert difference(queries.QUERIES[name](spark, sf), database(sf), queries.ORACLES[name]) is None


def test_query_against_all_windows(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(queries.QUERIES["op1_phrases"](spark, sf).collect()) == plain(docs)


def shared_texts(seed, n=60):
    """Documents pieced together from common passages of 45 to 130 words and words of their own."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [rng.choices(vocabulary, k=rng.randrange(45, 130)) for _ in range(8)] + [["a"] * 70, ["a", "b"] * 40]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(0, 5)):
            p = rng.choice(passages)
            a = rng.randrange(0, 10)
            words += rng.choices(vocabulary, k=rng.randrange(0, 40)) + p[a : len(p) - rng.randrange(0, 10)]
        docs.append((i * 7 % 61, "\n".join(words)))
    return docs


@pytest.mark.parametrize("seed, key_docs", [(1, 50_000), (2, 3)])
def test_passages_against_all_windows(spark, monkeypatch, seed, key_docs):
    monkeypatch.setattr(phrases, "KEY_DOCS", key_docs)  # read where the plan is made: spreads every key over shards
    docs = shared_texts(seed)
    found = phrases.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    rows = {r.doc_id: (r.n_words, sum(x.end - x.start for x in r.ranges), r.kept_sha256) for r in found}
    assert rows == plain(docs)


@pytest.mark.parametrize("seeds, letters", [(32, 1_000_000), (0, 1_000_000), (32, 150), (0, 150)])
def test_shard_finds_every_window(monkeypatch, seeds, letters):
    """By seeds or by windows, in one automaton or several, repeated words or not."""
    monkeypatch.setattr(phrases, "SEEDS", seeds)
    monkeypatch.setattr(phrases, "LETTERS", letters)
    rng = random.Random(9)
    for vocabulary in ([f"{i}" for i in range(500)], ["a", "b"], ["a"]):
        words = rng.choices(vocabulary, k=400)
        shard, owners = phrases.Shard(), {}
        for at in range(0, 340, 20):
            text = " ".join(words[at : at + 60]).encode()
            for key, start, n in zip(*(x.tolist() for x in phrases.keyed_runs(text))):
                part = text.split()[start : start + n + 49]
                shard.add(key, b" ".join(part), [(i, 7) for i in range(n)])
                owners.setdefault(key, set()).update(tuple(part[i : i + 50]) for i in range(n))
        target = " ".join(words[5:390] + ["new"] + words[100:180]).encode()
        for key, start, n in zip(*(x.tolist() for x in phrases.keyed_runs(target))):
            part = target.split()[start : start + n + 49]
            want = [(i, 7) for i in range(n) if tuple(part[i : i + 50]) in owners.get(key, ())]
            assert [h for h in shard.locate(key, b" ".join(part))] == want


def test_word_hashes():
    text = " tick\x0btock\x85 tick\n\nÜber tick ".encode()
    hashes, starts = phrases.hashes_of(text)
    assert [text[s:].split()[0] for s in starts] == text.split()
    assert hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 3
    assert len(phrases.hashes_of(b"")[0]) == len(phrases.hashes_of(b" \n ")[0]) == 0
    long = phrases.hashes_of(b"x" * 200_000 + b" y")[0]
    assert long[1] == phrases.hashes_of(b"y")[0][0]


def test_rolling_and_smallest():
    values = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    for n in (1, 2, 25, 26, 50):
        assert phrases.smallest(values, n).tolist() == [min(values[i : i + n]) for i in range(201 - n)]
    for n in (25, 50):
        twice = phrases.rolling(np.concatenate((values, values)), n)
        assert (twice[: 201 - n] == twice[200:]).all() and len(np.unique(twice)) == 200
        assert (twice[: 201 - n] == phrases.rolling(values, n)).all()


def test_edge_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    data = [(5, passage), (None, passage), (None, "x " + passage), (3, passage + " y"), (3, passage), (7, None), (8, ""), (9, passage), (9, passage)]
    data.append((1, "long " * 60_000))
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as key", "'z' as seg")
    rows = sorted((r.doc_id or 99, r.n_words, sum(x.end - x.start for x in r.ranges)) for r in phrases.repeats(docs).collect())
    assert rows == [(1, 60000, 0), (3, 60, 0), (3, 61, 0), (5, 60, 60), (7, 0, 0), (8, 0, 0), (9, 60, 60), (9, 60, 60), (99, 60, 60), (99, 61, 60)]
    assert phrases.repeats(docs.filter("false")).count() == 0
