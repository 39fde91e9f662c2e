import re
from collections import Counter

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from tickloom.llm import fertility, queries


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_query_against_the_definition(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_fertility"](spark, sf).collect()
    assert len(rows) == len(texts)
    model = sentencepiece.SentencePieceProcessor(model_file=fertility.default_vocabulary())
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    for r in rows[:40]:
        ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]) for i in model.encode(w)]
        share = np.array(list(Counter(ids).values())) / len(ids)
        assert np.isclose(r.chars_per_token, r.word_chars / len(ids))
        if len(ids) > 1:
            assert np.isclose(r.entropy, -(share * np.log2(share)).sum() / np.log2(len(ids)))


def test_words_are_spelled_as_in_the_text():
    model = sentencepiece.SentencePieceProcessor(model_file=fertility.default_vocabulary())
    spell = fertility.speller(fertility.default_vocabulary())
    text = "A plain text, with 12 numbers, ümläute and 漢字 🙂 x"
    assert [i for ids in spell(text.encode().split()) for i in ids] == model.encode(text)


def test_bands_by_language_and_script(spark):
    rng = np.random.default_rng(4)
    calm = "time people water house small large green river stone bread light morning evening garden letter number music window".split()
    data = [(i, " ".join(rng.choice(calm, 80)), "en" if i % 2 else None) for i in range(400)]
    data += [(1000, " ".join("".join(rng.choice(list("qxzjkvw"), 7)) for _ in range(300)), "en")]
    data += [(1001, " ".join("".join(rng.choice(list("ᚠᚢᚦᚨᚱᚲ"), 4)) for _ in range(300)), "en")]
    data += [(1002, " ".join("".join(rng.choice(list("ᚠᚢᚦᚨᚱᚲ"), 4)) for _ in range(300)), "rare")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in fertility.judged(docs).collect()}
    assert all(rows[i].kept for i in range(400)) and {rows[0].group, rows[1].group} == {"script latin", "en"}
    assert not rows[1000].kept and not rows[1001].kept and rows[1001].byte_share > 0.5
    assert not rows[1002].kept  # its language has one document, so the bands of all documents judge it, mostly


def test_bands_widen_without_a_step(spark):
    """A group's band moves from that of its script to its own, and no size turns the verdict by itself."""
    rng = np.random.default_rng(6)
    calm = "time people water house small large green river stone bread light morning evening garden letter number music window".split()
    data = [(i, " ".join(rng.choice(calm, 80)), "en") for i in range(300)]
    data += [(1000 + i, " ".join("".join(rng.choice(list("qxzjkvw"), 7)) for _ in range(90)), "own") for i in range(120)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    for n in (1, 49, 50, 51):
        rows = fertility.judged(docs.filter(f"doc_id < {1000 + n}")).collect()
        assert {r.kept for r in rows if r.doc_id >= 1000} == {False} and all(r.kept for r in rows if r.doc_id < 1000)
    limits = {}
    for n in (49, 50, 120):
        sound = fertility.measures(docs.filter(f"doc_id < {1000 + n}")).withColumn("group", F.col("lang"))
        found = fertility.bands(sound, sound.select("group", "script").distinct()).filter("group = 'own'").first()
        limits[n] = found.chars_per_token_low
    assert abs(limits[49] - limits[50]) < 0.05 and limits[120] < limits[50]


def test_repeated_words_of_very_many_different_words():
    rng = np.random.default_rng(7)
    numbers = np.concatenate((np.arange(2**21 + 5), rng.integers(0, 2**21 + 5, 1000), [5, 6, 7, 9, 5, 6, 7]))
    rng.shuffle(numbers[: 2**21])
    seen = Counter(zip(numbers.tolist(), numbers[1:].tolist(), numbers[2:].tolist()))
    covered = np.zeros(len(numbers), bool)
    for i, w in enumerate(zip(numbers.tolist(), numbers[1:].tolist(), numbers[2:].tolist())):
        if seen[w] > 1:
            covered[i : i + 3] = True
    assert fertility.repeated_words(numbers) == covered.sum() >= 6
    assert fertility.repeated_words(np.array([5, 0, 1, 7, 5, 2**21, 1])) == 0
    assert fertility.repeated_words(np.array([5, 0, 1, 2**40, 5, 0, 1])) == 6


def test_small_groups_are_judged_by_their_script(spark):
    rng = np.random.default_rng(5)
    calm = "time people water house small large green river stone bread light morning evening garden letter number music window".split()
    data = [(i, " ".join(rng.choice(calm, 80)), "en") for i in range(200)]
    data += [(1000 + i, " ".join("".join(rng.choice(list("qxzjkvw"), 7)) for _ in range(300)), lang) for i, lang in enumerate(["e n", "en", None])]
    data += [(2000 + i, " ".join(rng.choice(calm, 80)), lang) for i, lang in enumerate(["e n", None])]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    rows = fertility.judged(docs).collect()
    assert len(rows) == len(data)
    assert {r.doc_id for r in rows if not r.kept} == {1000, 1001, 1002}


def test_edge_rows(spark):
    data = [(1, None, None), (None, "", "en"), (2, "a b c " * 40_000, ""), (2, "a b c " * 40_000, ""), (3, "x\n\nx\n x", "en")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").selectExpr("*", "1 as script", "2 as n_words")
    rows = sorted(((r.doc_id or 0, r.n_words, r.n_dup_lines, r.n_repeat_words, r.kept) for r in fertility.judged(docs).collect()))
    assert rows == [(0, 0, 0, 0, False), (1, 0, 0, 0, False), (2, 120000, 0, 120000, False), (2, 120000, 0, 120000, False), (3, 3, 1, 0, False)]
    assert fertility.judged(docs.filter("false")).count() == 0
    assert fertility.judged(docs.drop("lang")).count() == 5
