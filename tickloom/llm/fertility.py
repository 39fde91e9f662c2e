"""Quality rules by tokenizer fertility.

A public vocabulary with byte fallback spells every word. Three figures follow for each document: characters per token,
the share of tokens that are fallback bytes, and the entropy of its tokens as a share of the largest possible for so many
tokens. Over all documents that pass the base rules, quartiles are taken per language, or per script where no language is
given, and drawn towards wider ones: a group of n documents has n parts of its own quartiles and DRAW of its script's, and
a script likewise of those over all documents, so that every document is judged by a band, small groups mostly by that of
what they belong to, and no size makes a difference of kind. A document is rejected when its characters per token lie further than a reach outside the quartiles of its group,
its byte share above, or its entropy below. The reach is REACH quartile distances for long documents and grows as
sqrt(1 + SHORT / tokens) for short ones, whose figures scatter more.
Quartiles are exact up to the rounding of the figures to STEP.

Base rules: at least 50 words, and at most half of them in three-word windows that occur twice or more.

Rows: a null text has no words and fails the base rules; a null or empty language means that the script decides; repeated
rows get equal results and each counts in the statistics. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Spelled, batch_of, blocks, bounds, stored, worker_cache

REACH, SHORT, DRAW, STEP = 4.0, 300, 50, 1000
FIGURES = {"chars_per_token": ("low", "high"), "byte_share": ("high",), "entropy": ("low",)}  # and the sides they reject on
EDGES = ("low", "high", "reach")
FLOORS = {"chars_per_token": 0.05, "byte_share": 0.01, "entropy": 0.01}  # quartile distances are at least this

_BLANKS, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
SCRIPTS = {
    "latin": "A-Za-zª-ɏḀ-ỿ", "greek": "Ͱ-Ͽἀ-῿", "cyrillic": "Ѐ-ԯ",
    "hebrew": "֐-׿", "arabic": "؀-ۿݐ-ݿ", "devanagari": "ऀ-ॿ", "thai": "฀-๿",
    "kana": "぀-ヿ", "hangul": "가-힯ᄀ-ᇿ", "han": "㐀-䶿一-鿿",
}
_SCRIPT = {name: re.compile(f"[{ranges}]+") for name, ranges in SCRIPTS.items()}


def script_of(text: str) -> str:
    """The script with most characters; `none` without any."""
    if text.isascii():
        return "latin" if _SCRIPT["latin"].search(text) else "none"
    sizes = {name: sum(map(len, found.findall(text))) for name, found in _SCRIPT.items()}
    best = max(sizes, key=sizes.get)
    return best if sizes[best] else "none"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def speller(path: str):
    """Pieces never cross a blank in these vocabularies, so words are spelled one by one, each after a blank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda words: model.encode([w.decode("utf-8") for w in words], num_threads=1)


def is_byte(path: str) -> np.ndarray:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return np.array([model.is_byte(i) for i in range(model.vocab_size())])


def _windows(numbers: np.ndarray) -> np.ndarray:
    """One number per three-word window, the same for the same words. numbers: one per different word."""
    if numbers.max() < 2**21:
        return (numbers[:-2] << 42) | (numbers[1:-1] << 21) | numbers[2:]
    # more words than three numbers in 64 bits can tell apart: pairs get numbers of their own first
    words, own = np.unique(numbers, return_inverse=True)
    _, pairs = np.unique(own[:-1] * len(words) + own[1:], return_inverse=True)
    return pairs[:-1] * len(words) + own[2:]


def repeated_words(numbers: np.ndarray) -> int:
    """Words in three-word windows found twice or more."""
    if len(numbers) < 4:
        return 0
    windows = _windows(numbers)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= twice
    return int(covered.sum())


def _measure(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Spelled = worker_cache("fertility", f"words {path}", lambda: Spelled(speller(path)))
        byte = worker_cache("fertility", f"bytes {path}", lambda: is_byte(path))
        for ids, texts in blocks(batches):
            texts = [t or b"" for t in texts]
            words = [t.split() for t in texts]
            flat = [w for own in words for w in own]
            tokens, lengths = table.tokens(flat)
            numbers = table.numbers(flat)
            word_at = bounds(map(len, words))
            token_at = bounds(lengths)[word_at]
            rows = []
            for i, text in enumerate(texts):
                own = tokens[token_at[i] : token_at[i + 1]]
                plain = text.decode("utf-8")
                chars = len(plain) - (len(text) - len(text.translate(None, _BLANKS)))
                lines = [line for line in text.split(b"\n") if line.strip()]
                counts = np.bincount(own)
                counts = counts[counts > 0]
                entropy = float(np.log2(len(own)) - (counts * np.log2(counts)).sum() / len(own)) if len(own) else 0.0
                rows.append((
                    len(words[i]), chars, len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
                    repeated_words(numbers[word_at[i] : word_at[i + 1]]),
                    chars / max(len(own), 1), float(byte[own].mean()) if len(own) else 0.0,
                    entropy / np.log2(len(own)) if len(own) > 1 else 0.0, script_of(plain),
                ))
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FIGURES, "script")
            kinds = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.string()]
            yield batch_of(
                doc_id=pa.array([i["id"] for i in ids], pa.int64()), lang=pa.array([i["lang"] for i in ids], pa.string()),
                **{n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(zip(names, kinds))},
            )

    return run


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", path: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, lang, the base counts, the three figures, the script."""
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.struct(F.col(id_col).cast("long").alias("id"), lang.alias("lang")).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    schema = (
        "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        + ", ".join(f"{name} double" for name in FIGURES) + ", script string"
    )
    return rows.mapInArrow(_measure(path or default_vocabulary()), schema)


def quartiles(rows: DataFrame, *group: str) -> DataFrame:
    """The group columns, name (of the figure), n, low and high, from rows with the group and the figures."""
    rounded = rows.select(*group, *(F.round(F.col(f) * STEP).cast("long").alias(f) for f in FIGURES))
    long = rounded.select(*group, F.explode(F.array(*(F.struct(F.lit(f).alias("name"), F.col(f).alias("value")) for f in FIGURES))).alias("x"))
    counts = long.groupBy(*group, "x.name", "x.value").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy(*group, "name").agg(
        F.percentile("value", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"), F.sum("n").alias("n")
    )
    return found.select(*group, "name", "n", (F.col("q")[0] / STEP).alias("low"), (F.col("q")[1] / STEP).alias("high"))


def _drawn(own: DataFrame, wider: DataFrame, keys: list[str]) -> DataFrame:
    """The quartiles of `own`, drawn towards those of `wider` by DRAW documents; without own ones, the wider ones."""
    other = wider.select(*keys, F.col("low").alias("wide_low"), F.col("high").alias("wide_high"))
    n = F.coalesce("n", F.lit(0))
    edges = [
        ((n * F.coalesce(e, F.lit(0.0)) + DRAW * F.col(f"wide_{e}")) / (n + DRAW)).alias(e) for e in ("low", "high")
    ]
    return own.join(other, keys).select(*(c for c in own.columns if c not in ("low", "high")), *edges)


def bands(sound: DataFrame, pairs: DataFrame, reach: float = REACH) -> DataFrame:
    """For each pair of group and script: per figure its quartiles (low, high) and the reach beyond them."""
    names = F.explode(F.array(*map(F.lit, FIGURES))).alias("name")
    scripts = pairs.select("script").distinct().select("script", names).join(quartiles(sound, "script"), ["script", "name"], "left")
    by_script = _drawn(scripts, quartiles(sound), ["name"])
    groups = pairs.select("group", "script", names).join(quartiles(sound, "group"), ["group", "name"], "left")
    found = _drawn(groups, by_script, ["script", "name"])
    floor = F.create_map(*(x for name, least in FLOORS.items() for x in (F.lit(name), F.lit(least))))[F.col("name")]
    found = found.withColumn("reach", F.greatest(F.col("high") - F.col("low"), floor) * reach)
    one = [F.max(F.when(F.col("name") == f, F.col(c))).alias(f"{f}_{c}") for f in FIGURES for c in EDGES]
    return found.groupBy("group", "script").agg(*one)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", path: str | None = None) -> DataFrame:
    """The measures with group, base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    group = F.coalesce(F.nullif(F.col("lang"), F.lit("")), F.concat(F.lit("script "), "script"))
    rows = measures(docs, id_col, text_col, lang_col, path).withColumn("base_failed", failed).withColumn("group", group)
    rows = stored(rows, "fertility")
    edges = [f"{f}_{c}" for f in FIGURES for c in EDGES]
    # the pairs are few, so the rows themselves are joined once
    limits = stored(bands(rows.filter("not base_failed"), rows.select("group", "script").distinct()), "bands")
    both = rows.join(limits, ["group", "script"], "left")
    wide = F.sqrt(1 + SHORT / F.greatest(F.col("word_chars") / F.greatest("chars_per_token", F.lit(0.01)), F.lit(1)))
    inside = F.lit(True)
    for f, sides in FIGURES.items():
        if "low" in sides:
            inside = inside & F.coalesce(F.col(f) >= F.col(f"{f}_low") - wide * F.col(f"{f}_reach"), F.lit(True))
        if "high" in sides:
            inside = inside & F.coalesce(F.col(f) <= F.col(f"{f}_high") + wide * F.col(f"{f}_reach"), F.lit(True))
    return both.withColumn("kept", ~F.col("base_failed") & inside).drop(*edges)
