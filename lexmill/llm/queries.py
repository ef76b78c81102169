"""The operators' queries over the driver's tables, with production parameters, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import chat_collapse, decontamination, langid, lm_interpolation, ngram_join, packing, quality_gbdt, token_counts, topk_ball, toxicity
from lexmill.llm._common import table


def op1_quality_gbdt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_gbdt.score(docs, quality_gbdt.fit(docs, table(spark, sf_dir, "labels")))


def op2_topk_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_ball.search(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op3_packing_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), k=5, percent=75)


def op6_lm_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_interpolation.score(table(spark, sf_dir, "documents"))


def op7_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.render(table(spark, sf_dir, "conversations"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op10_toxicity_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (
    op1_quality_gbdt, op2_topk_ball_tree, op3_packing_concat_cut, op4_token_counts, op5_ngram_jaccard_join, op6_lm_interpolation, op7_chat_collapse, op8_decontamination, op9_language_mixture, op10_toxicity_counterfactual,
)}

ORACLES = {
    "op2_topk_ball_tree": """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
""",
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce((SELECT min(v) FROM r WHERE r.u = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
""",
    "op7_chat_collapse": chat_collapse.ORACLE,
}
