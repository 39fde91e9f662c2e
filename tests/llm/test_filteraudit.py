from collections import Counter
from itertools import permutations

import numpy as np
from compare import database, difference
from pyspark.sql import functions as F

from tickloom.llm import filteraudit, queries

SCHEMA = "doc_id long, text string, source string, part string, fails string, n int"


def docs_of(spark, data):
    return spark.createDataFrame([(i, t, s, "x", "y", 1) for i, t, s in data], SCHEMA)


def labels_of(spark, data):
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")


def plain(data, labels):
    """Every filter, order and step, document by document."""
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    first = {}
    for i, text, _ in data:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = []
    for i, text, part in data:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > first[text],
        }
        rows.append((part or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for order in permutations("ABCDE"):
        for part, fails, is_good, is_toxic in rows:
            for step, letter in enumerate(order):
                own = out.setdefault((part, "".join(order), step + 1), Counter())
                before = bool(fails & set(order[:step]))
                failing = letter in fails
                own["kept"] += not (before or failing)
                own["removed"] += failing and not before
                own["redundant"] += failing and before
                own["unique_fails"] += fails == {letter}
                own["good_lost"] += failing and not before and is_good
                own["toxic_lost"] += failing and not before and is_toxic
    shapley = Counter()
    for (part, order, step), own in out.items():
        shapley[part, order[step - 1]] += own["removed"]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {k: (*(own[n] for n in names), shapley[k[0], k[1][k[2] - 1]]) for k, own in out.items()}


def found(rows):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows.collect()}


def test_query_against_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op11_filteraudit"
    assert difference(queries.QUERIES[name](spark, sf), database(sf), queries.ORACLES[name]) is None


def made_up():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    data = []
    for i in range(60):
        text = " ".join(rng.choice(words[: rng.choice([20, 400])], rng.choice([50, 250])))
        text += rng.choice(["", " #", " ABCDEFGHIJ" * 8, " Ünï\x0bcode\x1c Ab"])
        data.append((i, text, ["a", "b", None][i % 3]))
    data += [(100 + i, data[i][1], "b") for i in range(0, 30, 3)]
    data += [(None, None, None), (None, "", "a"), (200, "", "a"), (200, "", "b"), (7, data[9][1], "a"), (9, data[9][1], "a")]
    return data + [(300, "", ""), (301, "x " * 300, "only"), (302, " \t\n", "only")]


def test_against_plain_counts(spark):
    data = made_up()
    labels = [(i, i % 2, i % 5 == 0 and 1 or None) for i in range(0, 220, 3)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1), (999, 1, 1)]
    rows = filteraudit.audit(docs_of(spark, data).repartition(5), labels_of(spark, labels))
    got, want = found(rows), plain(data, labels)
    assert got == want and len(got) == 120 * 5 * 4


def test_small_blocks_and_buckets_change_nothing(spark):
    docs = docs_of(spark, made_up())
    blocks = filteraudit.coded(docs, size=300)
    assert blocks.count() > 20
    sent = filteraudit.numbered(blocks, words=10)
    assert sent.agg(F.max("bucket")).first()[0] > 20
    matrix, words = filteraudit.shards(blocks, sent), {r.number: r.word for r in filteraudit.dictionary(sent).collect()}
    assert len(set(words.values())) == len(words)
    rows = []
    for shard in matrix.collect():
        indptr, indices, data = (np.frombuffer(shard[c], k) for c, k in (("indptr", "<i8"), ("indices", "<i8"), ("data", "<u4")))
        for k, row in enumerate(shard.rows):
            a, b = indptr[k], indptr[k + 1]
            rows.append((row.doc_id, dict(zip((words[w] for w in indices[a:b].tolist()), data[a:b].tolist()))))
    want = [(i, dict(Counter(w.decode() for w in (t or "").encode().split()))) for i, t, _ in made_up()]
    assert sorted((repr(i), sorted(c.items())) for i, c in rows) == sorted((repr(i), sorted(c.items())) for i, c in want)
    sums = {(r.doc_id, r.n_words, r.n_distinct) for r in filteraudit.figures(blocks, sent).collect()}
    assert sums == {(i, sum(c.values()), len(c)) for i, c in want}


def test_a_text_in_a_third_of_all_rows(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "IF(id % 3 = 1, 'same # text', concat('own ', id)) AS text", "concat('s', id % 2) AS source")
    rows = filteraudit.audit(docs.repartition(16), labels_of(spark, [(1, 1, 1)])).filter("filter_order = 'EABCD' AND step = 1").collect()
    assert {r.part: (r.removed, r.kept) for r in rows} == {"s0": (1500, 3000), "s1": (1499, 3001)}


def test_a_long_text_and_an_empty_table(spark):
    text = " ".join(f"w{i % 3000}" for i in range(1_000_000))  # several stretches
    rows = filteraudit.audit(docs_of(spark, [(1, text, "a")]), labels_of(spark, [])).filter("filter_order = 'ABCDE'").collect()
    assert {r.step: (r.removed, r.kept) for r in rows} == {1: (0, 1), 2: (1, 0), 3: (0, 0), 4: (0, 0), 5: (0, 0)}
    assert filteraudit.audit(docs_of(spark, [(1, "a", "a")]).filter("false"), labels_of(spark, [])).count() == 0
