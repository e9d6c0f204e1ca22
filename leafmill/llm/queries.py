"""The queries opN_<name> over whole tables, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import chat, embedding_dedup, filter_audit, language_id, merkle, packing, pieces, quality, secrets, simhash, token_counts, token_files, topk
from leafmill.runtime import table


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k_of_table(table(spark, sf_dir, "embeddings"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_conversations(table(spark, sf_dir, "conversations"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_check(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_topk, op2_embedding_dedup, op3_secrets, op4_chat, op5_quality, op6_packing, op7_token_counts, op8_pieces, op9_token_files, op10_simhash, op11_filter_audit, op12_language_id, op13_merkle)
    return {f.__name__: f for f in own}


TOPK_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE u AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
e AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) >= 0.98 * sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))
    AND list_inner_product(a.v, a.v) > 0 AND list_inner_product(b.v, b.v) > 0),
reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings WHERE vec_id IS NOT NULL
  UNION
  SELECT r.node, e.b FROM reach r JOIN e ON e.a = r.other),
c AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
d AS (SELECT a AS node, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY a)
SELECT m.vec_id, coalesce(d.n, CAST(0 AS BIGINT)) AS n_links, coalesce(c.component_id, m.vec_id) AS component_id,
  coalesce(c.component_id = m.vec_id, false) AS kept
FROM embeddings m LEFT JOIN c ON c.node = m.vec_id LEFT JOIN d ON d.node = m.vec_id
"""


def oracle_sql() -> dict[str, str]:
    """The others learn, tokenize, hash with XXH64 or walk automata; tests hold them against plain versions."""
    return {"op1_topk": TOPK_SQL, "op2_embedding_dedup": EMBEDDING_DEDUP_SQL, "op11_filter_audit": filter_audit.AUDIT_SQL, "op13_merkle": merkle.MERKLE_SQL}
