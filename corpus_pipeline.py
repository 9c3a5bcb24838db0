"""A training corpus from raw documents: each stage calls one operator of casegauge.llm.

quality rules (rejected documents go) -> near-duplicates (one document of each group stays)
-> secrets (their spans are blanked out) -> mixing (documents stand as often as the mix takes
them) -> BPE (ids of every document, checked by decoding).

``run`` writes every stage's result to the shared folder and rereads it, so a lost executor
costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegauge.llm import bpe, mixing, near_dup, quality, secrets
from casegauge.llm.common import Scratch, table


# rows of whole texts that go to Python at once: by default 10,000, which is hundreds of MB of
# buffers on both sides where documents are long
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """The session's Arrow batches hold at most ``BATCH_ROWS`` rows from now on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.POLICY_V1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dup.keep_one(docs, k=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.expand(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), bpe.vocabulary_path())
    return coded.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("secrets", secret_scan), ("mixing", mix_sources), ("bpe", tokenize)]

# subword merges and the flow aren't expressible: tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, scratch.stage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        scratch.drop(before)
    return docs
