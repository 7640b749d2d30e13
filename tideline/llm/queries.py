"""Registered queries of the corpus operators, with the SQL that checks them where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, divergence, language_id, line_dedup, lm_score, packing, quality, secret_scan, sharding, simhash, span_dedup, toxicity, whitening
from tideline.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@_query(
    "op1_decontaminate",
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
q AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM p))),
h AS (SELECT r, i, n, item FROM q JOIN p USING (n, words)),
c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS k FROM h) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.contamination(documents(spark, folder), items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        "contaminated",
    )


@_query("op2_secrets")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, folder))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select("doc_id", *(count(k) for k in secret_scan.BASE_KINDS), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


@_query("op3_simhash")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


@_query("op4_line_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, folder))
    return found.select("doc_id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), F.array_join("removed", ",").alias("removed_lines"), F.sha2("text", 256).alias("text_sha256"))


@_query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held = language_id.held_out("doc_id", 3, 1)
    model = language_id.learn(docs.where(~held))
    return language_id.identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


@_query("op6_span_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = span_dedup.dedup_spans(documents(spark, folder))
    return found.select("doc_id", "n_sentences", "n_removed", "first_docs", F.sha2("text", 256).alias("text_sha256"), "text")


@_query("op7_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judge(documents(spark, folder))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log10_prob", "symbols")


@_query("op8_shards")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(documents(spark, folder), 40)


@_query("op9_lm_score")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(documents(spark, folder), language_id.held_out("doc_id", 5, 1))


@_query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder))


@_query("op11_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held = language_id.held_out("doc_id", 5, 0)
    scorer = toxicity.learn(docs.where(~held), spark.read.parquet(f"{folder}/labels.parquet").where(~held))
    return toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), scorer).drop("text")


@_query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))


_SHARE = "1 + CAST((CAST(1000000000 AS HUGEINT) * ({count} + 5)) // ({total} + 5 * v) AS BIGINT)"


@_query(
    "op13_divergence",
    r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
w AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
c AS (SELECT w.lang, w.source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, coalesce(total_lang, 0) AS total_lang FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM k GROUP BY 1) USING (lang)),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, SHARE_OWN AS p, SHARE_LANG AS q
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
o AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(o.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN o ON o.lang = a.lang AND o.source = a.source AND o.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x) WHERE part = 'pair' OR rank <= 50""".replace(
        "SHARE_OWN", _SHARE.format(count="coalesce(c.n, 0)", total="g.total")
    ).replace("SHARE_LANG", _SHARE.format(count="k.n_lang", total="g.total_lang")),
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(documents(spark, folder))
