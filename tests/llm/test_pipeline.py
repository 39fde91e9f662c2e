"""The pipeline's stages on the smallest tables, each against a plain version on that stage's own input."""

import re

import pytest
from test_packing import whole
from test_private import base
from test_simhash import plain_groups, plain_print

import corpus_pipeline
from tickloom.llm import private, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Name -> rows that went in and rows that came out."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF).cache()
        out[name] = (docs.collect(), made.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
        docs = made
    return out


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "private", "packing"]


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    rejected = {r.doc_id for r in before if model.score(r.text.encode())[0] >= 0.5}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == rejected
    toxic = {r.doc_id for r in labels.collect() if r.toxic}
    clean = {r.doc_id for r in labels.collect() if not r.toxic}
    assert toxic & rejected and len(clean & rejected) <= 0.02 * len(clean)


def test_one_of_each_text_stays(stages):
    before, after = stages["exact_dedup"]
    groups = {}
    for r in before:
        groups.setdefault(re.sub("[\\x20\\x09-\\x0D]", "", r.text), []).append((-len(r.text), r.doc_id))
    assert {r.doc_id for r in after} == {min(g)[1] for g in groups.values()}


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_dedup"]
    groups = plain_groups([(r.doc_id, plain_print(r.text)) for r in before])
    assert {r.doc_id for r in after} == set(groups.values())


def test_personal_data_is_masked(stages):
    before, after = stages["private"]
    texts = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        assert base(texts[r.doc_id]) == [] or r.text != texts[r.doc_id]
        assert r.n_chars == len(r.text) and not private.base_spans(r.text)


def test_every_token_is_packed_once(stages):
    before, after = stages["packing"]
    pieces = {}
    for r in after:
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    for r in before:
        ids = b"".join(part for _, part in sorted(pieces[r.doc_id]))
        assert ids == b"".join(i.to_bytes(4, "little") for i in [*whole(r.text), 1])


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.start, r.length, bytes(r.ids))
    assert sorted(map(key, rows)) == sorted(map(key, stages["packing"][1]))


def test_stages_on_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b", "en", "s", 3), (2, "a b", "en", "s", 3), (3, "word " * 30_000, None, "s", 150_000)]
    spark.createDataFrame([(2, 1, 0), (None, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows, kept in ((data, 3), ([], 0)):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path)).cache()
            if name == "private":
                assert docs.count() == kept
        assert (docs.count() > 0) == bool(rows)
