import random

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import pieces, queries

VOCABULARY = pieces.Vocabulary.load(pieces.default_vocabulary())


def one_by_one(word, scores, longest):
    """The largest sum of scores over all segmentations, by plain recursion over ends."""
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            value = scores.get(word[start:end], (pieces.UNKNOWN if end - start == 1 else -np.inf, 0))[0]
            best[end] = max(best[end], best[start] + value)
    return best[-1]


def total(ids, vocabulary):
    by_id = {i: s for s, i in vocabulary.scores.values()}
    return sum(by_id[i] for i in ids)


def test_scores_against_plain_recursion():
    rng = random.Random(1)
    for _ in range(30):
        names = {"".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(14)} | set("abc")
        small = pieces.Vocabulary({p: (-rng.uniform(0.5, 9), i) for i, p in enumerate(sorted(names))}, [0] * 256, [p.encode() for p in sorted(names)])
        words = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 12))) for _ in range(60)})
        for word, ids in zip(words, small.encode_sorted(words)):
            assert b"".join(small.spelled[i] for i in ids).decode() == word
            assert np.isclose(total(ids, small), one_by_one(word, small.scores, small.longest))
        assert list(small.encode_sorted(words[::-1])) == list(small.encode_sorted(words))[::-1]


def test_scores_against_the_library():
    """The same vocabulary read as a unigram model finds segmentations of equal score."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(pieces.default_vocabulary(), "rb").read())
    proto.trainer_spec.model_type = 1
    other = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = "the quick internationalisation of unthinkable Straßenbahn überholt señores déjà 12345 x-ray (foo) naïve".split()
    for word in words:
        ids = next(VOCABULARY.encode_sorted([pieces.MARK + word]))
        assert total(ids, VOCABULARY) == total(other.nbest_encode(word, nbest_size=2)[0], VOCABULARY)
        assert VOCABULARY.decode(ids).decode() == word


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=["Cs"], blacklist_characters="▁"), max_size=40))
def test_round_trip(text):
    words = pieces.marked(text)
    order = sorted(set(words))
    ids = dict(zip(order, VOCABULARY.encode_sorted(order)))
    assert VOCABULARY.decode([i for w in words for i in ids[w]]).decode() == text


def test_no_piece_crosses_a_blank():
    assert not [p for p in VOCABULARY.scores if pieces.MARK in p.lstrip(pieces.MARK)]


def test_query_round_trip(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_pieces"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert (r.n_tokens > 0) == bool(texts[r.doc_id])


def test_edge_rows(spark):
    data = [(1, None), (None, "a"), (2, ""), (3, "  "), (4, "word " * 40_000), (5, "x" * 50_000), (6, "a▁b"), (7, "same"), (7, "same")]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "0 as ids")
    got = sorted(((r.doc_id or 0, r.text) for r in pieces.decode(pieces.encode(docs)).collect()))
    assert got == sorted((i or 0, (t or "").replace("▁", " ")) for i, t in data)
    assert pieces.decode(pieces.encode(docs.filter("false"))).count() == 0
