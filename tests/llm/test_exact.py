from compare import database, difference
from pyspark.sql import functions as F

from tickloom.llm import exact, queries

SCHEMA = "doc_id long, text string, digest string, kept int"


def rows(spark, data):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in data], SCHEMA)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    name = "op2_exact_dedup"
    assert difference(queries.QUERIES[name](spark, sf), database(sf), queries.ORACLES[name]) is None


def test_winner_ties_nulls_and_repeats(spark):
    data = [(5, "a b"), (3, "ab"), (4, "a b"), (None, "a  b"), (7, None), (8, ""), (8, ""), (9, " \x0b"), (10, " ")]
    got = exact.exact_groups(rows(spark, data)).collect()
    of = {}
    for r in got:
        of.setdefault((r.doc_id, r.n_chars), []).append(r)
    assert of[5, 3][0].keep_id is None and of[5, 3][0].group_size == 4  # the longest text has no id
    assert of[None, 4][0].kept
    assert {r.keep_id for r in got if r.doc_id in (7, 8, 9)} == {9}
    assert of[10, 1][0].kept and of[10, 1][0].group_size == 1
    assert sum(r.kept for r in got) == 3


def test_repeated_rows_keep_one(spark):
    data = [(1, "same")] * 5 + [(2, "other")] * 2
    assert sorted((r.doc_id, r.kept) for r in exact.exact_groups(rows(spark, data)).collect()).count((1, True)) == 1
    assert sorted(r.doc_id for r in exact.without_copies(rows(spark, data)).collect()) == [1, 2]


def test_empty_table_and_columns(spark):
    empty = rows(spark, [(1, "a")]).filter("false")
    assert exact.exact_groups(empty).count() == 0
    assert exact.without_copies(rows(spark, [(1, "a"), (2, "a ")])).collect() == rows(spark, [(2, "a ")]).collect()


def test_hot_digests_are_found(spark):
    many = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"), F.col("id").alias("doc_id"))
    digests = many.repartition(7).select(exact.digest(F.col("text")).alias("digest"))
    found = exact.frequent(digests, 8).collect()
    hot = many.filter("text = 'hot'").select(exact.digest(F.col("text")).alias("d")).first().d
    assert hot in [r.digest for r in found] and len(found) <= 8
    groups = exact.exact_groups(many, counters=8)
    assert groups.filter("group_size > 1").agg(F.count("*"), F.min("keep_id"), F.sum(F.col("kept").cast("int"))).first()[:] == (6667, 0, 1)


def test_the_longest_of_rows_with_one_id_stays(spark):
    data = [(i, "a" + " " * k + "b") for i in (None, *range(20)) for k in (1, 5, 3)]
    data = [(i, t + f"{i}") for i, t in data]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    kept = exact.without_copies(docs).collect()
    assert sorted(len(r.text) - len(str(r.doc_id)) for r in kept) == [7] * 21
