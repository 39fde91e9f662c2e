import random

import numpy as np

from tickloom.llm import queries, toxicity

CALM = "the river runs past old houses and quiet gardens while people talk about weather bread music trains".split()


def corpus(spark, n=600, seed=1):
    """A third of the documents have one sentence with a slur; nothing else tells them apart."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 3 == 0)
        sentences = [" ".join(rng.choices(CALM, k=rng.randrange(4, 9))) for _ in range(rng.randrange(2, 9))]
        if toxic:
            at = rng.randrange(len(sentences))
            words = sentences[at].split()
            words.insert(rng.randrange(len(words)), rng.choice(["Blorkface", "grobnik", "zuddling", "zuddlers"]))
            sentences[at] = " ".join(words)
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_offending_sentences_are_located(spark):
    docs, labels = corpus(spark)
    held_out, kinds = corpus(spark, 200, 2)
    model = toxicity.train(docs, labels)
    texts = {r.doc_id: r.text for r in held_out.collect()}
    truth = {r.doc_id: r.toxic for r in kinds.collect()}
    for r in toxicity.score(held_out, model).collect():
        assert (r.score >= toxicity.CUT) == bool(truth[r.doc_id])
        assert len(r.sentences) == truth[r.doc_id]
        for s in r.sentences:
            assert any(w in texts[r.doc_id][s.start : s.end].lower() for w in ("blorkface", "grobnik", "zuddl"))
    assert toxicity.accepted(held_out, model).count() == sum(not t for t in truth.values())


def test_noisy_or():
    model = toxicity.Model(-3.0, {b"bad$": 4.0})
    p = lambda z: 1 / (1 + np.exp(-z))
    score, hits = model.score("Fine. é bad! Fine\n\n ok".encode())
    assert np.isclose(score, 1 - (1 - p(-3)) ** 3 * (1 - p(1))) and [h[:2] for h in hits] == [(5, 12)]
    assert np.isclose(model.score(b"one. two")[0], 1 - (1 - p(-3)) ** 2)


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op8_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    own = [r for r in rows if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.toxic for r in own) >= 0.9 * len(own)


def test_a_clean_document_is_kept_whatever_its_length(spark):
    docs, labels = corpus(spark)
    # a fifth of the positive labels have nothing in their text
    vague = labels.selectExpr("doc_id", "if(doc_id % 12 = 1, 1, toxic) as toxic")
    model = toxicity.train(docs, vague)
    clean = ". ".join(" ".join(random.Random(i).choices(CALM, k=6)) for i in range(10_000))
    data = [(1, clean), (2, "people talk."), (3, clean + ". you grobnik"), (4, "")]
    rows = spark.createDataFrame(data, "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score(rows, model).collect()}
    assert score[1] == score[2] and 0 < score[1] < toxicity.CUT <= score[3] and score[4] == 0
    assert sorted(r.doc_id for r in toxicity.accepted(rows, model).collect()) == [1, 2, 4]


def test_edge_rows(spark):
    docs, labels = corpus(spark, 90)
    model = toxicity.Model(-3.0, {b"bad$": 9.0})
    data = [(1, None, 0.5), (None, "bad", 0.5), (2, "", 0.5), (2, "", 0.5), (3, "bad " * 30000, 0.5), (4, "...", 0.5)]
    odd = spark.createDataFrame(data, "doc_id long, text string, score double")
    got = sorted((r.doc_id or 0, r.score) for r in toxicity.score(odd, model).collect())
    assert [s > 0.5 for _, s in got] == [True, False, False, False, True, False]
    kept = toxicity.accepted(odd, model)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 4]
    # labels without a document, null ones, repeated ones, none at all
    more = labels.union(spark.createDataFrame([(None, 1), (5, None), (10**9, 1), (0, 0)], labels.schema))
    assert toxicity.train(docs, more).weights
    none = toxicity.train(docs, labels.filter("false"))
    assert toxicity.score(docs, none).agg({"score": "max"}).first()[0] == 0
    assert toxicity.score(docs.filter("false"), model).count() == 0


def test_a_long_text_with_many_offending_sentences():
    import time

    model = toxicity.Model(-3.0, {b"bad$": 6.0}, -4.0)

    def spent(n):
        text = ("Ein schöner Tag. Ünd bad Wörter! " * n).encode()
        started = time.perf_counter()
        hits = model.score(text)[1]
        found = list(toxicity.code_points(text, hits))
        return time.perf_counter() - started, text.decode(), found

    _, text, found = spent(50)
    assert [text[a:b] for a, b in found] == [" Ünd bad Wörter"] * 50
    short, long = spent(15_000)[0], spent(150_000)[0]  # 0.5 and 5 MB
    assert len(spent(1000)[2]) == 1000 and long < 40 * short
