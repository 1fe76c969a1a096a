"""Queries of this package by name, and their expected SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from assayline.llm import conversations, language, pii, quality, substring_dedup
from assayline.llm.bpe_tree import encode_digests
from assayline.llm.cover_tree import top_k
from assayline.llm.decontaminate import find_leaks
from assayline.llm.divergence import divergence
from assayline.llm.license_scan import scan_licenses
from assayline.llm.near_dedup import near_duplicates
from assayline.llm.suffix_dedup import deduplicate
from assayline.llm.tables import documents, ship
from assayline.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(documents(spark, sf_dir), labels)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op4_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.fit(docs))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(documents(spark, sf_dir), benchmark).drop("key")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    damaged = conversations.damaged(turns)
    return conversations.audit(conversations.repair(damaged, present="present"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.remove_windows(documents(spark, sf_dir)))


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), v AS (
  SELECT lang, count(*) AS size, sum(n) AS total FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term
), t AS (
  SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), p AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * v.size) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // (v.total + 5 * v.size) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang)
  LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM o WHERE part = 'pair' OR rank <= 50
"""


WINDOWS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), x AS (
  SELECT id, doc_id, p, array_to_string(w[p : p + 12], ' ') AS t
  FROM (SELECT id, doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)
), m AS (
  SELECT t, min(doc_id) AS least FROM x GROUP BY t
), c AS (
  SELECT DISTINCT id, p + k AS place
  FROM (SELECT id, p, unnest(range(0, 13)) AS k FROM x JOIN m USING (t) WHERE least < doc_id)
), u AS (
  SELECT id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d
), k AS (
  SELECT id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM u ANTI JOIN c USING (id, place) GROUP BY id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(kept, '') AS kept
FROM d LEFT JOIN k USING (id)
"""


def _shipping(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_quality": op1_quality,
        "op2_near_dedup": op2_near_dedup,
        "op3_pii": op3_pii,
        "op4_bpe_tree": op4_bpe_tree,
        "op5_top_k": op5_top_k,
        "op6_language": op6_language,
        "op7_token_counts": op7_token_counts,
        "op8_decontaminate": op8_decontaminate,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_license_scan": op10_license_scan,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_source_divergence": op12_source_divergence,
        "op13_substring_dedup": op13_substring_dedup,
    }
    return {name: _shipping(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op5_top_k": TOP_K_SQL, "op12_source_divergence": DIVERGENCE_SQL, "op13_substring_dedup": WINDOWS_SQL}
