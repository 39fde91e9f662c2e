"""Exact duplicates by heavy-hitter split.

Misra-Gries summaries of the digests, one per partition and merged by sums, name every digest that holds more than
2/(counters+1) of all rows, and at most `counters` digests in all. Their winners are then taken exactly from all rows
and broadcast, so the rows of the hot groups are decided without a shuffle. All other digests are grouped and joined by
an ordinary shuffle, in which no group is larger than that share.

Rows: a null text counts as empty; a null doc_id loses against any other; of rows equal in text and doc_id exactly one
is kept. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACES, batch_of, stored, texts_of

COUNTERS = 1024  # bounds the broadcast: so many digests of 32 bytes with their winners


def normal(text: F.Column) -> F.Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digest(text: F.Column) -> F.Column:
    return F.unhex(F.sha2(normal(text), 256))


def merge_counts(counts: dict, more: dict, counters: int) -> dict:
    """Two Misra-Gries summaries as one: add, then take the (counters + 1)th largest count from all."""
    for key, n in more.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) > counters:
        cut = sorted(counts.values(), reverse=True)[counters]
        counts = {key: n - cut for key, n in counts.items() if n > cut}
    return counts


def _summaries(counters: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            more = dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist()))
            counts = merge_counts(counts, more, counters)
        yield batch_of(digest=pa.array(list(counts), pa.binary()), seen=pa.array(list(counts.values()), pa.int64()))

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, among them all with more than 2 / (counters + 1) of the rows."""
    summary = digests.select("digest").mapInArrow(_summaries(counters), "digest binary, seen long")
    least = digests.count() / (counters + 1)
    # a summary never counts too much, so at most `counters` digests can pass
    return summary.groupBy("digest").agg(F.sum("seen").alias("seen")).filter(F.col("seen") > F.lit(least))


def _winner() -> list[F.Column]:
    # max() of a struct: most characters, then the smallest doc_id (null last), then the first row
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row")))
    return [best.alias("best"), F.count(F.lit(1)).alias("group_size")]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of `docs`: doc_id, digest, n_chars, row, keep_id, group_size, kept."""
    texts = texts_of(docs, id_col, text_col).select(
        "doc_id", digest(F.col("text")).alias("digest"), F.length(F.coalesce("text", F.lit(""))).alias("n_chars")
    )
    rows = stored(texts.withColumn("row", F.monotonically_increasing_id()), "digests")
    candidates = stored(frequent(rows, counters), "frequent")
    hot = rows.join(F.broadcast(candidates.select("digest")), "digest")
    winners = F.broadcast(stored(hot.groupBy("digest").agg(*_winner()), "winners"))
    rest = rows.join(winners, "digest", "left_anti")
    decided = rows.join(winners, "digest").unionByName(rest.join(rest.groupBy("digest").agg(*_winner()), "digest"))
    return decided.select(
        "doc_id", "digest", "n_chars", "row",
        F.bitwise_not("best.id").alias("keep_id"), "group_size", (F.col("row") == F.bitwise_not("best.row")).alias("kept"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    names = [f"kept_{i}" for i in range(len(docs.columns))]
    kept = exact_groups(docs, id_col, text_col).filter("kept").select("doc_id", "digest", "n_chars")
    plain = docs.toDF(*names)
    own = plain.withColumn("id", F.col(names[docs.columns.index(id_col)]).cast("long"))
    text = F.col(names[docs.columns.index(text_col)]).cast("string")
    own = own.withColumn("digest", digest(text)).withColumn("n_chars", F.length(F.coalesce(text, F.lit(""))))
    same = own.id.eqNullSafe(kept.doc_id) & (own.digest == kept.digest) & (own.n_chars == kept.n_chars)
    both = own.join(kept, same, "left_semi")
    return both.dropDuplicates(["id", "digest"]).select(*names).toDF(*docs.columns)
