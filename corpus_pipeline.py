"""A corpus from raw documents to packed sequences, one stored stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import exact, packing, private, simhash, toxicity
from tickloom.llm.common import forget, read_documents, stored


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.without_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private.masked(docs, private.learn(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", toxic_filter),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("private", mask_private),
    ("packing", pack),
]

ORACLE_SQL = None  # classifiers, SimHash and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            forget(before)  # nothing reads a stage's documents once those of the next one are stored
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
