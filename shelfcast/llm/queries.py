"""Registered queries of the operators, over whole tables, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    bpe, language, mixing, neighbours, pii, prefix_trie, simhash, suffixes, token_counts, topk, url_filter, warc, whitening,
)
from shelfcast.llm.blocks import vectors
from shelfcast.llm.common import table

# The rules that op4 judges by.
RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


def op1_simhash_bk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)


def op2_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold(F.col("doc_id")) == 1, F.lit(False))
    model = language.learn(docs.filter(~held_out))
    return language.identify(docs, model).withColumn("held_out", held_out)


def op3_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(table(spark, sf_dir, "embeddings"), nonzero=True)
    return neighbours.nearest(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_sanitised_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.find(table(spark, sf_dir, "documents")))


def op6_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=100, kept=False)


def op8_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(table(spark, sf_dir, "embeddings")).withColumn("vec", topk.quantised(F.col("vec")))
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.in_training_order(mixing.assign(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position")


def op11_rank_merged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), wanted=32)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_bk_tree, op2_language_codes, op3_learned_partitions, op4_url_cascade, op5_sanitised_spans,
        op6_chunked_bpe, op7_suffix_dedup, op8_warc_members, op9_uniform_threshold, op10_curriculum_mix, op11_rank_merged_counts, op12_prefix_trie,
        op13_lanczos_whitening, pipeline,
    )
}

OP4_SQL = """
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
  )
),
rules(r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
judged AS (
  SELECT p.*, (
    SELECT max(struct_pack(n := length(r_host || r_path), rule := r_host || r_path, verdict := r_verdict)) FROM rules
    WHERE (p.host = r_host OR ends_with(p.host, '.' || r_host)) AND starts_with(p.path, r_path)
  ) AS best FROM parts p
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

OP8_SQL = """
WITH hashed AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM firsts
"""

OP9_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP12_SQL = """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda crc, b:
             list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda r, _: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h
  FROM own
),
turns AS (
  SELECT c.conv_id, 0 AS part, o.* EXCLUDE (conv_id) FROM convs c JOIN own o ON o.conv_id = c.base AND o.k <= c.h
  UNION ALL SELECT c.conv_id, 1, o.* EXCLUDE (conv_id) FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.k > c.h
),
paths AS (
  SELECT conv_id, list('/' || md5(role) || md5(text) ORDER BY part, k) AS path, list(CAST(octet_length(encode(text)) AS BIGINT) ORDER BY part, k) AS sizes
  FROM turns GROUP BY conv_id
),
whole AS (SELECT c.conv_id, coalesce(path, []) AS path, coalesce(sizes, []) AS sizes FROM convs c LEFT JOIN paths USING (conv_id)),
steps AS (
  SELECT conv_id, d AS depth, len(path) AS n, list_slice(path, 1, d) AS key, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
  FROM whole, unnest(generate_series(0, len(path))) AS t(d)
),
nodes AS (
  SELECT array_to_string(key, '') AS key, array_to_string(list_slice(key, 1, depth - 1), '') AS up, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM steps GROUP BY ALL
),
kids AS (SELECT up, count(*) AS kids FROM nodes WHERE depth > 0 GROUP BY up),
full_nodes AS (SELECT n.*, coalesce(kids, 0) AS n_children FROM nodes n LEFT JOIN kids ON kids.up = n.key),
below AS (
  SELECT a.key, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((b.n_convs - 1) * b.size) AS saved_tokens
  FROM full_nodes a JOIN full_nodes b ON starts_with(b.key, a.key) GROUP BY a.key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below USING (key) LEFT JOIN full_nodes p ON p.key = n.up AND n.depth > 0
"""

ORACLES = {"op4_url_cascade": OP4_SQL, "op8_warc_members": OP8_SQL, "op9_uniform_threshold": OP9_SQL, "op12_prefix_trie": OP12_SQL}
