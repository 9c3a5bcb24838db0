"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegauge.llm import (bpe, bpe_sql, hnsw, lm_score, merkle, mixing, near_dup, quality,
                           secrets, sharding, toxicity, vector_codes, warc)
from casegauge.llm.common import table

QUERY_EVERY = 100


def op1_hnsw(spark: SparkSession, d: str) -> DataFrame:
    """The 10 nearest rows of each vector whose id is divisible by 100."""
    vectors = table(spark, d, "embeddings")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), k=10)


def op2_secrets(spark: SparkSession, d: str) -> DataFrame:
    """Secrets of every document: base counts and digest, and all spans."""
    return secrets.report(secrets.find(table(spark, d, "documents")))


def op3_near_dup(spark: SparkSession, d: str) -> DataFrame:
    """Components of near-duplicate documents (4-word shingles, similarity 0.8)."""
    return near_dup.near_duplicates(table(spark, d, "documents"), k=4, percent=80)


def op4_lm_score(spark: SparkSession, d: str) -> DataFrame:
    """Every document's cross-entropy difference; target: documents labelled good."""
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return lm_score.cross_entropy_difference(table(spark, d, "documents"), good)


def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    """The rule ledger of every document, with the base and the current policy's verdict."""
    rows = quality.apply_policy(quality.ledger(table(spark, d, "documents")), quality.POLICY_V1)
    return rows.withColumn("base_failed", quality.fails(quality.BASE)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed")


def op6_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.place(table(spark, d, "documents"))


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Every document's toxicity, learned from labelled rows that aren't held out."""
    documents = table(spark, d, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, d, "labels")))


def op8_warc(spark: SparkSession, d: str) -> DataFrame:
    """All pages through ARC and WARC archives, as read back from them."""
    return warc.archive_pages(table(spark, d, "pages"))


def op9_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Every document encoded and decoded again: token count and digests."""
    return bpe.digest(table(spark, d, "documents"), bpe.vocabulary_path())


def op10_mixing(spark: SparkSession, d: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mixture(table(spark, d, "documents"))


def op11_bpe_sql(spark: SparkSession, d: str) -> DataFrame:
    """Every document encoded by ranks and decoded again: token count and digests."""
    return bpe_sql.digest(table(spark, d, "documents"), bpe_sql.vocabulary_path())


def op12_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes and exact errors of all vectors, and the digest of the codebooks."""
    return vector_codes.digest(table(spark, d, "embeddings"))


def op13_merkle(spark: SparkSession, d: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, checked after tampering."""
    return merkle.verification(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_hnsw, op2_secrets, op3_near_dup, op4_lm_score, op5_quality,
                            op6_sharding, op7_toxicity, op8_warc, op9_bpe, op10_mixing, op11_bpe_sql,
                            op12_vector_codes, op13_merkle)}
