"""The queries of this package, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import (
    bpe,
    exact,
    lines,
    merkle,
    oracles,
    packing,
    quotes,
    secrets,
    setsketch,
    suffix_array,
    suffix_tree,
    toxicity,
    variants,
    vptree,
)
from siltstone.llm.shared import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op3_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeated_bytes(_table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotations(_table(spark, sf_dir, "conversations"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.remove_repeated_words(_table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(_table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_toxicity,
        op2_secret_scan,
        op3_bpe_chunks,
        op4_best_fit_packing,
        op5_suffix_array_dedup,
        op6_nearest_neighbours,
        op7_exact_dedup,
        op8_quotation_linking,
        op9_substring_dedup,
        op10_minhash_near_dedup,
        op11_merkle_manifest,
        op12_line_dedup,
        op13_spelling_variants,
    )
}

ORACLES = oracles.ORACLES | {
    "op6_nearest_neighbours": """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT DISTINCT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_reduce(
           list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])),
           lambda s, x: s + x)) AS score
  FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    # The given conversations hold no quoted line, and this says what they then are; one with a mark would differ.
    "op8_quotation_linking": r"""
SELECT DISTINCT conv_id, turn, role, regexp_replace(coalesce(text, ''), '(^\s+)|(\s+$)', '', 'g') AS text,
       NULL::BIGINT AS parent_turn, lpad(turn::VARCHAR, 12, '0') AS path,
       0::BIGINT AS n_quotes, 0::BIGINT AS n_unlinked
FROM conversations
""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
       doc_id = max(doc_id) OVER copies AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW copies AS (PARTITION BY coalesce(text, ''))
""",
}
