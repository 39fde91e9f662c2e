import random

import numpy as np

from tickloom.llm import language, queries

WORDS = {
    "en": "the and with that water house through would people there which because thing every night light".split(),
    "de": "der und mit dass wasser haus durch würde leute dort welche weil ding jede nacht licht zwischen".split(),
    "el": "και το νερό σπίτι με που άνθρωποι γιατί πράγμα κάθε νύχτα φως ανάμεσα όταν μέσα".split(),
}


def corpus(spark):
    rng = random.Random(2)
    data = []
    for i in range(240):
        lang = ("en", "de", "el")[i % 3]
        data.append((i, " ".join(rng.choices(WORDS[lang], k=40)), lang))
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def best_path(scores, switch):
    """All label sequences, the first best one."""
    from itertools import product

    def value(path):
        return sum(s[p] for s, p in zip(scores, path)) - switch * sum(a != b for a, b in zip(path, path[1:]))

    return max(value(p) for p in product(range(scores.shape[1]), repeat=len(scores))), value


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(7)
    sizes = np.array([0, 1, 5, 6, 2, 0, 7, 4])
    scores = rng.normal(size=(sizes.sum(), 3)) * 3
    labels = language.viterbi(scores, sizes, 2.0)
    at = 0
    for n in sizes:
        if n:
            most, value = best_path(scores[at : at + n], 2.0)
            assert np.isclose(value(labels[at : at + n].tolist()), most)
        at += n


def test_cells_of_words_do_not_depend_on_neighbours():
    own, sizes = language.grams(["ab", "c", "déf"])
    for i, word in enumerate(["ab", "c", "déf"]):
        a = sizes[:i].sum()
        alone, n = language.grams([word])
        assert n[0] == sizes[i] == sum(max(len(word) + 3 - k, 0) for k in language.SIZES)
        assert sorted(alone.tolist()) == sorted(own[a : a + sizes[i]].tolist())


def test_mixed_text_is_cut_into_spans(spark):
    model = language.train(corpus(spark))
    text = " ".join(WORDS["en"][:9] + WORDS["de"][:8] + ["12", "--"] + WORDS["el"][:12])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = language.identify(docs, model).first()
    spans = {s.lang: (s.start, s.end) for s in row.spans}
    assert row.lang_pred == "el" and 0.3 < row.score < 0.6
    assert spans["en"] == (0, 9) and spans["de"][0] == 9 and spans["el"][1] == 31 and spans["el"][0] in (17, 18, 19)
    greek = language.SCRIPTS.index("greek")
    assert model.allowed[greek].tolist() == [False, True, False]  # de, el, en


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op6_language"](spark, sf).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)


def test_edge_rows(spark):
    model = language.train(corpus(spark).unionByName(spark.createDataFrame([(900, "x", None), (901, None, "en"), (None, "x", "")], "doc_id long, text string, lang string")))
    data = [(1, None), (None, "the water"), (2, ""), (3, "12 !? 7"), (4, "the und " * 40_000), (5, "the"), (5, "the"), (6, "漢字")]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'q' as lang_pred", "1 as score")
    rows = language.identify(docs, model).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(data) and got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[None] == got[5] == ("en", 1.0) and got[6][0] in model.languages
    assert language.identify(docs.filter("false"), model).count() == 0
    none = language.train(corpus(spark).filter("false"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
