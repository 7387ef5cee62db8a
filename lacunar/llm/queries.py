"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lacunar.llm.ann import adaptive_scan
from lacunar.llm.bitplane import encode_and_read_back
from lacunar.llm.jaccard import jaccard_components
from lacunar.llm.licenses import scan_licenses
from lacunar.llm.mixing import mix
from lacunar.llm.negatives import flipped, hard_negatives
from lacunar.llm.packing import LOSS, PROMPT_SHARE, SEGMENTS, pack
from lacunar.llm.simhash import near_duplicates
from lacunar.llm.substrings import repeated_spans
from lacunar.llm.suffix_tree import suffix_tree_scores
from lacunar.llm.topk import exact_top_k
from lacunar.llm.toxicity import fit, score
from lacunar.llm.whitening import whiten


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; it stays there."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_scan(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op2_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score(docs, fit(docs, _table(spark, sf_dir, "labels")))


def op3_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read_back(spark, _table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end=2)


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(_table(spark, sf_dir, "documents"), min_count=20, depth=4)


def op5_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op6_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op7_count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(_table(spark, sf_dir, "documents"))


def op8_exponential_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end=1, tokens=2048, segments=SEGMENTS, loss=LOSS, prompt_share=PROMPT_SHARE)


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"), k=10, every=100)


def op11_two_pass_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), k=32)


def op12_radix_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(flipped(_table(spark, sf_dir, "embeddings")), every=100)


def op13_prefix_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), shingle=3, percent=90)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_adaptive_scan, op2_ftrl_toxicity, op3_plane_files, op4_suffix_tree, op5_anchor_simhash, op6_license_automaton, op7_count_min_substrings, op8_exponential_mixing, op9_vector_packing, op10_exact_top_k, op11_two_pass_whitening, op12_radix_negatives, op13_prefix_jaccard)}


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


OP7_SQL = """
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, len(w) AS n, unnest(generate_series(1, len(w) - 19)) AS a FROM t WHERE len(w) >= 20
), k AS (
  SELECT s.doc_id, s.a, row_number() OVER (PARTITION BY array_to_string(t.w[s.a : s.a + 19], ' ') ORDER BY s.doc_id, s.a) AS r
  FROM s JOIN t USING (doc_id)
), g AS (
  SELECT DISTINCT doc_id, unnest(generate_series(a, a + 19)) AS i FROM k WHERE r > 1
), h AS (
  SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id
), p AS (
  SELECT t.doc_id, t.w, unnest(generate_series(1, len(t.w))) AS i FROM t JOIN h USING (doc_id)
), q AS (
  SELECT p.doc_id, string_agg(p.w[p.i], ' ' ORDER BY p.i) AS kept
  FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.doc_id
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(len(h.gone), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN h.doc_id IS NULL THEN array_to_string(t.w, ' ') ELSE coalesce(q.kept, '') END) AS kept_sha256
FROM t LEFT JOIN h USING (doc_id) LEFT JOIN q USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_count_min_substrings": OP7_SQL, "op10_exact_top_k": OP10_SQL, "op12_radix_negatives": OP12_SQL}
