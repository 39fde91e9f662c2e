import random
import struct
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing, queries

TOKENIZER = Tokenizer.from_file(packing.default_tokenizer())
CUTTER = packing.Cutter(packing.default_tokenizer())


def whole(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def spelled(text):
    return [i for ids in CUTTER.spell(CUTTER.keys(text.encode())) for i in ids]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=30))
def test_spelling_in_parts_equals_the_tokenizer(text):
    assert spelled(text) == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n'_.,-!09aBzéÉßÇœŒžŁйЖЁ’“–€\x1c\x00\x7f", max_size=40))
def test_plain_texts_are_cut_as_the_tokenizer_does(text):
    assert not text or isinstance((CUTTER.keys(text.encode()) or [""])[0], str)
    assert spelled(text) == whole(text)


def test_every_plain_character():
    plain = [chr(c) for c in range(0x2100) if packing._PLAIN.match(chr(c))]
    assert len(plain) > 500
    for c in plain:
        for text in (c, f"a{c}b", f"A{c} {c}.", f"e{c}1"):
            assert spelled(text) == whole(text), repr(text)


def test_spelling_of_marks():
    for text in ("It's 12 a.m., we'll GO_there!", "naïve ÀÉß straße 'tis ª º ² ½ × ÷", "<|endoftext|> a<|startoftext|>b", "é İx Σας __ a_b", "\x85a\xa0b\x1c"):
        assert spelled(text) == whole(text), text


def check(rows, docs):
    """Every id in one piece, every sequence gapless and at most WIDTH long."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in docs:
        ids = whole(text or "") + [1]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            own = ids[r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids) and r.length == len(own)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            at += r.length
        assert at == len(ids)
    for inside in by_sequence.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= packing.WIDTH
    return by_sequence


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sequences = check(queries.QUERIES["op7_packing"](spark, sf).collect(), docs)
    tokens = sum(length for inside in sequences.values() for _, length in inside)
    assert tokens > 0.9 * packing.WIDTH * len(sequences)


def test_patterns_hold_every_piece():
    rng = random.Random(3)
    for _ in range(20):
        histogram = {rng.randrange(1, 65): rng.randrange(1, 200) for _ in range(rng.randrange(1, 30))}
        found = packing.patterns(histogram, 64)
        placed = {}
        for packs, runs in found:
            assert sum(n * t for n, t in runs) <= 64
            for n, t in runs:
                placed[n] = placed.get(n, 0) + packs * t
        assert placed == histogram


def test_one_length_fills_its_packs(spark):
    assert packing.patterns({100: 1000}, 2048) == [(50, [(100, 20)])]
    assert sorted(packing.patterns({100: 1001}, 2048)) == [(1, [(100, 1)]), (50, [(100, 20)])]
    assert sum(packs for packs, _ in packing.patterns({1500: 3, 1: 10_000}, 2048)) == 8  # 14,500 ids
    docs = spark.createDataFrame([(i, None) for i in range(5000)], "doc_id long, text string")
    rows = packing.pack(packing.pieces(docs)).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 5000
    assert len({r.sequence_id for r in rows}) == 3 and max(r.offset for r in rows) < packing.WIDTH


def test_edge_rows_and_round_trip(spark):
    data = [(1, None, 0), (1, None, 0), (None, "", 0), (2, "One two " * 3000, 0), (3, "x", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, length int")
    placed = packing.pack(packing.pieces(docs))
    rows = placed.collect()
    assert sum(r.length for r in rows) == 3 + 6001 + 2
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    joined = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    for r in rows:
        assert joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert packing.pack(packing.pieces(docs.filter("false"))).count() == 0


def test_one_length_over_many_tasks(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'x', repeat('ab ', CAST(id % 50 AS INT))) AS text", "1 AS task", "'z' AS bases")
    rows = packing.pack(packing.pieces(docs.repartition(13), width=64), width=64).collect()
    assert len(rows) == 4000 and len({(r.sequence_id, r.offset) for r in rows}) == 4000
    inside = {}
    for r in rows:
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in inside.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in rows) > 0.9 * 64 * len(inside)


def test_a_text_of_many_stretches(spark):
    text = "Some words, é and 12 more. " * 250_000  # several stretches of 4 MB each
    rows = packing.pieces(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    one = whole("Some words, é and 12 more. ")
    assert rows[0].doc_tokens == 250_000 * len(one) + 1
    ids = b"".join(r.ids for r in sorted(rows, key=lambda r: r.start))
    assert ids == struct.pack(f"<{len(one)}I", *one) * 250_000 + struct.pack("<I", 1)
