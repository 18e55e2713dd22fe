"""Registered queries of this package: name -> ``(spark, sf_dir) -> DataFrame``,
and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (embedding_dedup, hard_negatives, lexical_search, license_scan, merge_dropout, mixing,
               near_duplicates, pii, pu_quality, quality_rules, sharding, token_counts, url_filter)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op3_jump_hash_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 7 by jump consistent hashing of doc_id."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


_URL_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)
),
ruled AS (
  SELECT *,
         CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
         regexp_extract(host, '(?:^|[.-])(adult|ads|bet|bets|betting|casino|escort|gambling|jackpot|pharmacy|pill|pills|poker|porn|slots|spam|viagra|xxx)(?:[.-]|$)', 1) AS word
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NULL AND word <> '' THEN 'block'
            ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL AND word <> '' THEN word END AS host_word
FROM ruled
"""


@register("op7_rarest_token_url_rules", _URL_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every url of pages by the production rules."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@register("op2_anchor_expansion_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@register("op5_risk_controlled_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every whole text of documents; cutoffs per language
    from all labelled documents."""
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_merge_dropout_pieces")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of documents with seeded merge-dropout, checked
    by decoding."""
    return merge_dropout.encode_documents(table(spark, sf_dir, "documents"))


@register("op10_trie_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of documents."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@register("op6_fast_similarity_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), 85).drop("row_key")


@register("op1_pu_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text of documents."""
    return pu_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op8_sorted_projection_passes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all vectors."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op4_soft_membership_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and rates of all documents for the production mix."""
    return mixing.mix_documents(table(spark, sf_dir, "documents"),
                                mixing.quality_domains(table(spark, sf_dir, "labels")))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"""

_SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
size AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
uses AS (SELECT r, doc_id, n, term, count(*) AS tf
         FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
         WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM uses, size GROUP BY term, n_docs),
scored AS (SELECT item_id, r, doc_id,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
           FROM uses, size, wanted, weight
           WHERE wanted.term = uses.term AND weight.term = uses.term GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@register("op11_bag_dedup_search", _SEARCH_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every item of benchmark."""
    return lexical_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """Blocks, overlaps and places of the production templates and phrases."""
    parsed = license_scan.parse_templates(license_scan.TEMPLATES, license_scan.PHRASES, license_scan.THRESHOLD)
    width = max(len(t.words) for t in parsed)
    held = ", ".join(f"({k}, '{t.label}', '{w.decode()}', {len(set(t.words))}, {t.least})"
                     for k, t in enumerate(parsed) if not t.phrase for w in sorted(set(t.words)))
    places = " UNION ALL ".join(
        f"SELECT r, p, '{t.label}' AS label FROM w WHERE " + " AND ".join(
            f"w{i} = '{x.decode()}'" for i, x in enumerate(t.words)) for t in parsed if t.phrase)
    following = ", ".join(f"lead(w0, {i}) OVER (PARTITION BY r ORDER BY p) AS w{i}"
                          for i in range(1, max(len(t.words) for t in parsed if t.phrase)))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
u AS (SELECT r, len(t) AS n, unnest(t) AS w0, unnest(range(len(t))) AS p FROM d),
w AS (SELECT r, n, p, w0, {following} FROM u),
held(k, label, word, size, least) AS (VALUES {held}),
blocked AS (SELECT r, n, w0, unnest([p // {width}, p // {width} - 1]) AS b FROM u
            WHERE w0 IN (SELECT word FROM held)),
matched AS (SELECT r, label, count(DISTINCT w0) / size AS containment
            FROM blocked JOIN held ON word = w0
            WHERE b >= 0 AND b <= greatest(0, (n + {width} - 1) // {width} - 2)
            GROUP BY r, b, k, label, size, least HAVING count(DISTINCT w0) >= least),
placed AS ({places}),
base AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM placed GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
          FROM (SELECT r, label, 1.0::DOUBLE AS containment FROM placed UNION ALL SELECT * FROM matched) GROUP BY r)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN every USING (r)
"""


@register("op12_set_join_license_scan", _license_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every whole text of documents."""
    return license_scan.digest(license_scan.find_licenses(table(spark, sf_dir, "documents")))


_NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS a_id, b.vec_id AS b_id, a.label = b.label AS same,
                 CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
          FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT a_id, b_id AS positive_id, score AS positive_score FROM pairs WHERE same
             QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY score DESC, b_id) <= 5)
SELECT a_id AS anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY a_id, positive_id ORDER BY score DESC, b_id) AS INTEGER) AS rank,
       b_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pairs USING (a_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY a_id, positive_id ORDER BY score DESC, b_id) <= 3
"""


@register("op13_hyperplane_tree_negatives", _NEGATIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, with every seventh label moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 50 == 0)
