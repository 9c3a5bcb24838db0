"""Incremental persistence and live counters with Structured Streaming.

Every sink keeps the keys it has seen in streaming state (``once``): a score that lands
again, in the same file, a copied file or a later one, is stored and counted once. State
lies in RocksDB under the checkpoint, so it isn't bounded by executor memory; with a
``watermark`` keys older than it are forgotten, for sources that repeat within a known time.

* ``save_scores_stream`` (R1/R2): landed score files -> ``foreachBatch`` writes each
  micro-batch into its own ``batch_id=N`` folder. A replayed batch (after a crash) rewrites the
  same folder with the same rows; restarting from the checkpoint resumes with the files
  not yet processed.
* ``save_results_stream`` (R1 with the record upsert): scores appended and record
  snapshots logged per micro-batch; ``current_records`` is the upserted record table.
* ``save_replies_stream`` (R1 with S6 J11 N8): landed JSON lines -> facts, per-batch counters,
  and a quarantine of what can't be stored, with the reason; ``readmit`` stores rows whose
  record or run has become known since.
* ``run_counters_stream`` (R3): a streaming grouped aggregate of verdict counts per run,
  emitted in ``update`` mode; each batch's changed rows are written the same way and
  ``read_merged`` keeps the newest row per run.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casegauge.operators import joins
from casegauge.operators import store as store_ops
from casegauge.sources.files import holds_parts

SCORE_SCHEMA = T.StructType([
    T.StructField("score_id", T.LongType()),
    T.StructField("case_id", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("verdict", T.StringType()),
    T.StructField("preconditions_passed", T.BooleanType()),
    T.StructField("test_steps_passed", T.BooleanType()),
    T.StructField("expected_results_passed", T.BooleanType()),
    T.StructField("validated_at", T.TimestampNTZType()),
])


# what identifies a score, however often it lands
SCORE_KEY = ("run_id", "case_id", "score_id")
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started inside keeps its state in RocksDB (a query copies the settings when it
    starts); the session's own setting stays as it was."""
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def once(stream: DataFrame, key: tuple[str, ...] = SCORE_KEY, watermark: str | None = None,
         time_col: str = "validated_at") -> DataFrame:
    """The first arrival of every key. Rows that lack a part of the key are told apart by
    their whole content. With ``watermark`` a key is remembered that long."""
    incomplete = reduce(or_, [F.col(k).isNull() for k in key])
    other = F.when(incomplete, F.sha2(F.to_json(F.struct(*stream.columns)), 256))
    keyed = stream.withColumn("__other", other)
    names = [*key, "__other"]
    if watermark:
        keyed = keyed.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(names)
    else:
        keyed = keyed.dropDuplicates(names)
    return keyed.drop("__other")


def land_files(df: DataFrame, path: str) -> None:
    """Write ``df`` as new files (an arrival), with the partitioning it has. The sinks'
    results do not depend on file order (merges go by timestamp, counters are sums)."""
    df.write.mode("append").parquet(path)


RECORD_CONTENT = ("title", "tribe", "product", "capability")
RESULT_SCHEMA = T.StructType(SCORE_SCHEMA.fields + [
    T.StructField(c, T.StringType()) for c in RECORD_CONTENT])


def save_results_stream(spark: SparkSession, src: str, store: str, checkpoint: str,
                        schema: T.StructType = RESULT_SCHEMA,
                        files_per_batch: int | None = None,
                        watermark: str | None = None) -> StreamingQuery:
    """R1 with U2 + U5: each landed result row is one scored record -- its content and
    its score. Per micro-batch, the scores are appended to ``{store}/facts`` and the
    record snapshots to the record log ``{store}/record_log`` (read through
    :func:`current_records`), each in a ``batch_id=N`` folder that a replayed batch
    overwrites with the same rows: exactly-once without rewriting what is stored."""
    facts_cols = [f.name for f in SCORE_SCHEMA.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _file(batch.select(*facts_cols), f"{store}/facts", batch_id)
            _file(batch.select("case_id", *RECORD_CONTENT, "score_id",
                               F.col("validated_at").alias("seen_at")),
                  f"{store}/record_log", batch_id)
        finally:
            batch.unpersist()

    results = once(_source(spark, src, schema, files_per_batch), watermark=watermark)
    return _start(spark, results, write, checkpoint)


REPLY_SCHEMA = T.StructType([T.StructField("reply_case_id", T.LongType()), *SCORE_SCHEMA.fields])
TORN = "_unparsed_line"
QUARANTINE_SCHEMA = T.StructType([
    *(f for f in SCORE_SCHEMA.fields if f.name in SCORE_KEY),
    T.StructField("reason", T.StringType()), T.StructField("stored", T.BooleanType()),
    T.StructField("raw", T.StringType())])


def checked(replies: DataFrame, records: DataFrame, runs: DataFrame) -> DataFrame:
    """Replies with ``reason``: why a row can't be stored (J11: unknown record or run; a key
    that is missing; a torn line), or what is odd about one that can (N8: the reply names
    another record; the score stays under the requested one); else null. ``stored`` tells the
    two apart.

    The batch's ids choose the known ones among the stored records (one column, semi join);
    the batch joins those back, so the record table isn't shuffled for a small batch."""
    ids = joins.broadcast_if_small(replies.select("case_id").distinct())[0]
    known = records.select("case_id").join(ids, "case_id", "left_semi").distinct() \
        .withColumn("__record", F.lit(True))
    opened = runs.select("run_id").distinct().withColumn("__run", F.lit(True))
    seen = replies.join(known, "case_id", "left").join(opened, "run_id", "left")
    c = F.col
    lost = (F.when(c(TORN).isNotNull(), F.lit("unreadable line"))
            .when(reduce(or_, [c(k).isNull() for k in SCORE_KEY]), F.lit("incomplete key"))
            .when(c("__record").isNull(), F.lit("unknown record"))
            .when(c("__run").isNull(), F.lit("unknown run")))
    odd = F.when(c("reply_case_id") != c("case_id"), F.lit("reply names another record"))
    return seen.withColumn("stored", lost.isNull()).withColumn("reason", F.coalesce(lost, odd)) \
        .drop("__record", "__run")


def _raw(columns: list[str]) -> Column:
    return F.coalesce(F.col(TORN), F.to_json(F.struct(*columns)))


def save_replies_stream(spark: SparkSession, src: str, store: str, checkpoint: str,
                        records: DataFrame, runs: DataFrame, files_per_batch: int | None = None,
                        watermark: str | None = None) -> StreamingQuery:
    """Landed JSON lines of replies (``REPLY_SCHEMA``), parsed by the scan
    itself. Per micro-batch three sinks, each a ``batch_id=N`` folder: ``{store}/facts`` (what
    can be stored), ``{store}/quarantine`` (``QUARANTINE_SCHEMA``: everything else and why, and
    the stored rows whose reply names another record), ``{store}/counters`` (the batch's own
    verdict counts per run, summed on read by :func:`read_counters`). ``records`` and
    ``runs`` are read anew for every batch."""
    lines = _json_source(spark, src, files_per_batch)
    facts_cols = [f.name for f in SCORE_SCHEMA.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # a stateful batch may run only once
        rows = checked(batch, records, runs).persist()
        try:
            facts = rows.where("stored").select(*facts_cols, "reply_case_id")
            _file(facts, f"{store}/facts", batch_id)
            _file(rows.where(F.col("reason").isNotNull()).select(
                *SCORE_KEY, "reason", "stored", _raw(REPLY_SCHEMA.fieldNames()).alias("raw")),
                f"{store}/quarantine", batch_id)
            _file(facts.groupBy("run_id").agg(*store_ops.verdict_counts(F.col("verdict"))),
                  f"{store}/counters", batch_id)
        finally:
            rows.unpersist()
            batch.unpersist()
    return _start(spark, once(lines, watermark=watermark), write, checkpoint)


def readmit(spark: SparkSession, store: str, records: DataFrame, runs: DataFrame,
            attempt: int) -> DataFrame:
    """Quarantined replies whose record and run are known by now, stored as the part
    ``readmit=attempt`` of facts and counters (the same attempt again replaces it). Returns the
    rows stored. Those of earlier attempts are left out."""
    waiting = spark.read.schema(QUARANTINE_SCHEMA).option("recursiveFileLookup", True) \
        .parquet(f"{store}/quarantine").where("not stored and reason like 'unknown%'")
    parsed = waiting.select(F.from_json("raw", REPLY_SCHEMA).alias("r")).select("r.*") \
        .withColumn(TORN, F.lit(None).cast("string"))
    before = [f"{store}/facts/readmit={i}" for i in range(attempt)]
    before = [p for p in before if holds_parts(spark, p)]
    if before:
        done = spark.read.parquet(*before).select(*SCORE_KEY)
        parsed = parsed.join(done, list(SCORE_KEY), "left_anti")
    rows = checked(parsed, records, runs).where("stored")
    path = f"{store}/facts/readmit={attempt}"
    rows.select(*SCORE_SCHEMA.fieldNames(), "reply_case_id").write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.groupBy("run_id").agg(*store_ops.verdict_counts(F.col("verdict"))).write.mode("overwrite") \
        .parquet(f"{store}/counters/readmit={attempt}")
    return out


def read_counters(spark: SparkSession, store: str) -> DataFrame:
    """R3 by addition: each run's counters as the sum of its batches' own counts; no fact is
    read."""
    parts = spark.read.option("recursiveFileLookup", True).parquet(f"{store}/counters")
    return parts.groupBy("run_id").agg(*[F.sum(c).alias(c) for c in (
        "passed_count", "needs_improvement_count", "failed_count", "error_count")])


def current_records(log: DataFrame, key: str = "case_id", content=RECORD_CONTENT,
                    ts: str = "seen_at", tie_break: str = "score_id") -> DataFrame:
    """The record table of the stream sink: U2 by merge-on-read over the record log
    (:func:`casegauge.operators.store.current_snapshot`)."""
    return store_ops.current_snapshot(log, key, content, ts, tie_break)


def _file(batch: DataFrame, sink: str, batch_id: int) -> None:
    """One micro-batch's rows in their own folder."""
    batch.withColumn("batch_id", F.lit(batch_id).cast("long")) \
        .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")


def _start(spark: SparkSession, rows: DataFrame, write, checkpoint: str,
           mode: str = "append") -> StreamingQuery:
    with _state_on_disk(spark):
        return (rows.writeStream.outputMode(mode).foreachBatch(write)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _json_source(spark: SparkSession, src: str, files_per_batch: int | None) -> DataFrame:
    """Landed JSON lines under ``REPLY_SCHEMA``; a line that isn't a JSON object of it has its
    text in ``TORN``."""
    r = spark.readStream.schema(T.StructType([*REPLY_SCHEMA.fields,
                                              T.StructField(TORN, T.StringType())])) \
        .option("columnNameOfCorruptRecord", TORN)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.json(src)


def _source(spark: SparkSession, src: str, schema: T.StructType,
            files_per_batch: int | None) -> DataFrame:
    """Landed Parquet files with a fixed schema. ``files_per_batch`` caps a micro-batch
    (``maxFilesPerTrigger``); by default each trigger takes every file that has arrived,
    so a large backlog is not cut into thousands of tiny batches."""
    r = spark.readStream.schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(src)


def save_scores_stream(spark: SparkSession, src: str, sink: str, checkpoint: str,
                       schema: T.StructType = SCORE_SCHEMA, files_per_batch: int | None = None,
                       watermark: str | None = None) -> StreamingQuery:
    """Persist every landed score exactly once (``availableNow``: process what is
    there, then stop; call again later to resume)."""
    scores = once(_source(spark, src, schema, files_per_batch), watermark=watermark)
    return _start(spark, scores, lambda batch, i: _file(batch, sink, i), checkpoint)


def run_counters_stream(spark: SparkSession, src: str, sink: str, checkpoint: str,
                        schema: T.StructType = SCORE_SCHEMA, files_per_batch: int | None = None,
                        watermark: str | None = None) -> StreamingQuery:
    """Live verdict counters per run; a score that lands again counts once."""
    scores = once(_source(spark, src, schema, files_per_batch), watermark=watermark)
    agg = scores.groupBy("run_id").agg(*store_ops.verdict_counts(F.col("verdict")))
    return _start(spark, agg, lambda batch, i: _file(batch, sink, i), checkpoint, "update")


def read_merged(spark: SparkSession, sink: str, key: list[str] | str) -> DataFrame:
    """Current state of a batch-folder sink: the newest row per key (merge on read)."""
    keys = [key] if isinstance(key, str) else key
    df = spark.read.parquet(sink)
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r", "batch_id")


def run_to_completion(q: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query, as long as it takes unless the caller gives a
    limit; its failure is raised here."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
