import random
import re

import numpy as np
import xxhash

from tickloom.llm import queries, simhash


def plain_print(text):
    """Bit by bit, as the definition says."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """doc -> smallest doc reachable, by trying all pairs."""
    parent = {d: d for d, _ in prints}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, p) in enumerate(prints):
        for b, q in prints[:i]:
            if (p ^ q).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: top(d) for d, _ in prints}


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op3_simhash"](spark, sf).collect()}
    prints = [(r.doc_id, plain_print(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    groups = plain_groups(prints)
    assert got == {d: (f"{p:016x}", groups[d]) for d, p in prints}


def test_links_of_crowded_keys(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(400):  # chains of near fingerprints that share most keys, and far ones
        p = rng.choice(sorted(prints))
        for _ in range(rng.choice((1, 3, 3, 9))):
            p ^= 1 << rng.randrange(40)
        prints.add(p)
    numbered = list(enumerate(sorted(prints)))
    signed = [(int(np.uint64(p).astype(np.int64)),) for _, p in numbered]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), tile=16)
    label = {r.member: r.root for r in simhash.components(edges).collect()}
    want = plain_groups(numbered)
    got = [label.get(s[0], s[0]) for s in signed]
    assert len(set(got)) == len(set(want.values()))
    assert len(set(zip(got, want.values()))) == len(set(got))


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(101, 100)], "u long, v long")
    got = {r.member: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}


def test_edge_rows(spark):
    data = [(3, None, 1), (2, "", 1), (None, " \n", 1), (7, "One two", 1), (8, "one TWO", 1), (8, "one TWO", 1), (9, "x " * 30000, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp int")
    got = sorted((r.doc_id or -1, r.fp, r.component_id) for r in simhash.near_groups(docs).collect())
    assert [c for _, _, c in got] == [2, 2, 2, 7, 7, 7, 9]
    assert got[0][1] == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 7, 9]
    assert simhash.near_groups(docs.filter("false")).count() == 0
