"""From raw documents to packed sequences, one stage after the other.

Each stage takes the session, the documents its predecessor kept and the
folder of the tables, and returns a frame; ``run`` writes it as Parquet in the
shared folder and rereads it as the next stage's documents. All but the last
return the columns they were given, whatever these are called. Rows without a
``doc_id`` cannot be told apart from others by it: they pass the two
deduplicating stages. Null texts are empty and stay null; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import exact, packing, secrets, setsketch, toxicity
from siltstone.llm.shared import ship, stored


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labelled ones."""
    ship(spark)
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text the one with the largest id stays, and of its repeated rows one.

    Different texts under one id are different documents, and all of them stay.
    """
    ship(spark)
    sha = _fresh(docs, "sha")
    kept_id, kept_sha = _fresh(docs, "kept_id"), _fresh(docs, "kept_sha")
    found = exact.exact_duplicates(docs).filter("kept OR doc_id IS NULL")
    kept = found.select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha)).distinct()
    hashed = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    once = hashed.join(kept, same, "left_semi")
    named = once.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", sha])
    return named.union(once.filter("doc_id IS NULL")).drop(sha)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together by texts of 85 per cent or more the one with the least id stays.

    A document is told by its id and text: another text under the id of one
    that goes stays. Of several texts under the least id the one whose hash is
    least stays.
    """
    ship(spark)
    key, gone = _fresh(docs, "near_key"), _fresh(docs, "gone_key")
    told = F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), told))
    found = setsketch.near_duplicates(keyed, id_column=key, percent=85).filter("NOT kept")
    dropped = found.select(F.col("doc_id").alias(gone)).distinct()
    return keyed.join(dropped, F.col(key) == F.col(gone), "left_anti").drop(key)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets replaced by a mark; ``n_chars`` follows."""
    ship(spark)
    masked = secrets.mask_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents that are left, with its place in a sequence."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_masking),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The classifier is trained and the tokens are the library's; SQL has neither.
ORACLE_SQL = None
