"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import credentials, crossentropy, exact, fertility, filteraudit, language, packing, phrases, pieces, private, simhash, toxicity, vectorcodes
from tickloom.llm.common import read_documents


def op1_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.repeats(read_documents(spark, sf_dir))
    n_removed = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r.end - r.start)
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), "kept_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(read_documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(read_documents(spark, sf_dir))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fertility.judged(read_documents(spark, sf_dir))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select(*base, *fertility.FIGURES)


def _span_rows(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s.base & (s.kind == kind))).cast("long").alias(f"n_{kind}")

    base = joined(F.filter("spans", lambda s: s.base))
    return found.select("doc_id", *map(number, kinds), F.sha2(base, 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op5_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return _span_rows(private.find(docs, private.learn(docs)), private.KINDS)


def _fold(folds: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    found = language.identify(docs, language.train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "spans")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read_documents(spark, sf_dir), with_ids=False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, skip=_fold(5) == 0)
    held_out = F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= toxicity.CUT).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", predicted, "sentences")


def op9_crossentropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    return crossentropy.score(read_documents(spark, sf_dir), good)


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = pieces.decode(pieces.encode(read_documents(spark, sf_dir)))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return decoded.select("doc_id", n_tokens, F.crc32("ids").alias("ids_crc32"), F.sha2("text", 256).alias("decoded_sha256"))


def op11_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectorcodes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    code = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    rows = vectorcodes.with_label_errors(found.rows)
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


def op13_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return _span_rows(credentials.find(docs, credentials.learn(docs)), credentials.KINDS)


QUERIES = {
    "op1_phrases": op1_phrases,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_simhash": op3_simhash,
    "op4_fertility": op4_fertility,
    "op5_private": op5_private,
    "op6_language": op6_language,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_crossentropy": op9_crossentropy,
    "op10_pieces": op10_pieces,
    "op11_filteraudit": op11_filteraudit,
    "op12_vectorcodes": op12_vectorcodes,
    "op13_credentials": op13_credentials,
}

def _codes_sql(rounds: int = 4) -> str:
    """Each round spelled out: assign all parts (a), then move the entries (c)."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
            SELECT row, part, min({{
                d: CAST(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v) AS BIGINT), entry: entry
            }}) AS best FROM p JOIN c{n} c USING (part) GROUP BY row, part
        )""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
            WITH s AS (
                SELECT part, best.entry AS entry, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                FROM (SELECT part, best, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM p JOIN a{n} USING (row, part)) GROUP BY ALL
            ), m AS (
                SELECT part, entry, list(CAST((s - (s % n + n) % n) // n AS DOUBLE) ORDER BY place) AS v FROM s GROUP BY part, entry
            )
            SELECT part, entry, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m USING (part, entry)
        )""")
    return f"""
        WITH v AS (
            SELECT vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS x, row_number() OVER (ORDER BY vec_id, x) AS row
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x for x in embedding if coalesce(isfinite(x), false)]) = len(embedding)
        ), p AS MATERIALIZED (
            SELECT row, part, x[len(x) // 4 * part + 1:len(x) // 4 * (part + 1)] AS v FROM v, (SELECT unnest(range(4)) AS part)
        ), c0 AS (
            SELECT part, row - 1 AS entry, v FROM p WHERE row <= 256
        ), {", ".join(steps)}, coded AS (
            SELECT row, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY row
        ), book AS (
            SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) for x in v], ','), ',' ORDER BY part, entry)) AS codebooks_sha256
            FROM c{rounds}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded JOIN v USING (row), book
    """


ORACLES = {
    "op1_phrases": r"""
        WITH split AS (
            SELECT doc_id, [w for w in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if w <> ''] AS words FROM documents
        ), word AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split
        ), windows AS (
            SELECT doc_id, i, string_agg(word, ' ') OVER w AS phrase, count(*) OVER w AS n
            FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
        ), first AS (
            SELECT phrase, min(doc_id) AS doc_id FROM windows WHERE n = 50 GROUP BY phrase
        ), hit AS (
            SELECT w.doc_id, w.i FROM windows w JOIN first f ON f.phrase = w.phrase AND f.doc_id < w.doc_id WHERE n = 50
        ), marked AS (
            SELECT word.*, count(hit.i) OVER (
                PARTITION BY word.doc_id ORDER BY word.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
            FROM word LEFT JOIN hit ON hit.doc_id = word.doc_id AND hit.i = word.i
        ), counted AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM marked GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN counted USING (doc_id)
    """,
    "op2_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), r AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w = 1 AS kept,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM n
            WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r
    """,
    "op11_filteraudit": r"""
        WITH word AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   [w for w in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if w <> ''] AS words
            FROM documents
        ), label AS (
            SELECT doc_id, max(CAST(quality = 1 AS BIGINT)) AS good, max(CAST(toxic = 1 AS BIGINT)) AS toxic FROM labels GROUP BY doc_id
        ), flag AS (
            SELECT doc_id, part, {
                A: len(words) < 200, B: 100 * len(list_distinct(words)) < 50 * len(words),
                C: 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), D: regexp_matches(text, '[#$%&*|]'),
                E: coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)
            } AS f FROM word
        ), one AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN f.A THEN 'A' ELSE '' END
                || CASE WHEN f.B THEN 'B' ELSE '' END || CASE WHEN f.C THEN 'C' ELSE '' END
                || CASE WHEN f.D THEN 'D' ELSE '' END || CASE WHEN f.E THEN 'E' ELSE '' END AS fails
            FROM flag LEFT JOIN label USING (doc_id)
        ), sets AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM one GROUP BY ALL
        ), letter AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
        ), step AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step
            FROM letter a, letter b, letter c, letter d, letter e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), gone AS (
            SELECT part, filter_order, step, fails, n, good, toxic, filter_order[step] AS letter, contains(fails, filter_order[step]) AS failing,
                   translate(filter_order[1:step - 1], fails, '') <> filter_order[1:step - 1] AS before
            FROM sets, step
        ), counted AS (
            SELECT part, filter_order, step, letter,
                   CAST(coalesce(sum(n) FILTER (NOT failing AND NOT before), 0) AS BIGINT) AS kept,
                   CAST(coalesce(sum(n) FILTER (failing AND NOT before), 0) AS BIGINT) AS removed,
                   CAST(coalesce(sum(n) FILTER (failing AND before), 0) AS BIGINT) AS redundant,
                   CAST(coalesce(sum(n) FILTER (fails = letter), 0) AS BIGINT) AS unique_fails,
                   CAST(coalesce(sum(good) FILTER (failing AND NOT before), 0) AS BIGINT) AS good_lost,
                   CAST(coalesce(sum(toxic) FILTER (failing AND NOT before), 0) AS BIGINT) AS toxic_lost
            FROM gone GROUP BY ALL
        )
        SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted
    """,
    "op12_vectorcodes": _codes_sql(),
}
