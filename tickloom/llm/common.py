"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import work_dir
from tickloom.sources.tables import remove

SPACES = " \t\n\x0b\x0c\r"  # what separates words, here and in bytes.split()
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_KEPT: dict[tuple[str, str], object] = {}  # per Python worker: what is dear to build and may serve the next task


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text alone, so that no other column can clash; a null text stays null."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table below the shared checkpoint folder: lineage ends there and every executor can read it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # Spark's cleaner then drops the shuffle files that led to this table
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more; what was stored from them stays."""
    for table in tables:
        remove(table.sparkSession, table.stored_at)


def worker_cache(operator: str, key: str, make: Callable[[], object]) -> object:
    """One object per Python worker, operator and key; it must not depend on anything but the key.

    A worker that turns to another operator drops what the last one left.
    """
    for other in [k for k in _KEPT if k[0] != operator]:
        del _KEPT[other]
    if (operator, key) not in _KEPT:
        _KEPT[operator, key] = make()
    return _KEPT[operator, key]


def stretches(text: bytes, size: int = 4_000_000) -> Iterator[bytes]:
    """The text cut at blanks into parts of about so many bytes; no word is cut."""
    at = 0
    while at < len(text):
        blank = _SPACE.search(text, at + size)
        end = blank.start() if blank else len(text)
        yield text[at:end] if at or blank else text
        at = end + 1


def blocks(batches: Iterable[pa.RecordBatch], chars: int = 400_000) -> Iterator[tuple[list, list[bytes | None]]]:
    """Ids and UTF-8 texts of whole documents, in lists of about so many bytes; one long document is a block by itself."""
    ids: list = []
    texts: list = []
    held = 0
    for batch in batches:
        numbers = batch.column("doc_id").to_pylist()
        column = batch.column("text").cast(pa.binary())
        for i, number in enumerate(numbers):
            text = column[i].as_py()
            ids.append(number)
            texts.append(text)
            held += len(text or b"")
            if held >= chars:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def batch_of(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def bounds(lengths: Iterable[int]) -> np.ndarray:
    """0 and the running totals."""
    return np.concatenate(([0], np.cumsum(np.fromiter(lengths, np.int64)))).astype(np.int64)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lengths[i]] for all i, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


def numbering() -> defaultdict:
    """A new key takes the next number."""
    own: defaultdict = defaultdict()
    own.default_factory = own.__len__
    return own


class Spelled:
    """Numbers keys (words, mostly) as they come and holds the ids that `spell` gives for each; forgets all beyond `limit` keys.

    The limit bounds memory only: a forgotten key is spelled again. `spell` takes a list of keys.
    """

    def __init__(self, spell: Callable[[list], Iterable[list[int]]], limit: int = 500_000):
        self.spell, self.limit = spell, limit
        self._forget()

    def _forget(self) -> None:
        self.own, self.starts, self.ids = numbering(), array("q", [0]), array("i")

    def numbers(self, keys: list) -> np.ndarray:
        before = len(self.own)
        found = np.fromiter(map(self.own.__getitem__, keys), np.int64, len(keys))
        if len(self.own) > before:
            fresh = list(islice(reversed(self.own), len(self.own) - before))[::-1]
            for at in range(0, len(fresh), 50_000):
                spelled = list(self.spell(fresh[at : at + 50_000]))
                self.ids.extend(chain.from_iterable(spelled))
                self.starts.extend(accumulate(map(len, spelled[1:]), initial=self.starts[-1] + len(spelled[0])))
        return found

    def tokens(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all keys, and how many each key has."""
        if len(self.own) > self.limit:
            self._forget()
        numbers = self.numbers(keys)
        starts = np.frombuffer(self.starts, np.int64)
        begins = starts[numbers]
        lengths = starts[numbers + 1] - begins
        return gather(np.frombuffer(self.ids, np.int32) if len(self.ids) else np.empty(0, np.int32), begins, lengths), lengths
