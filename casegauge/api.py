"""User-level entry points mirroring the reference's public functions.

Each is a composition of the operators. The store lies under one base folder, and nothing
stored is ever overwritten while it may be read:

* ``score_facts`` -- append-only; one part per call (or wave of a call), filed under its run.
  A part's tasks commit one by one, so a call that fails keeps what its finished tasks scored;
* ``run_counters`` -- one row per part: the part's own verdict counts, summed on read;
* ``test_cases``, ``current_scores``, ``score_history`` -- filed by the record's bucket, a base and
  deltas (``sources.buckets``): the records as upserted, each record's latest score, and all
  scores by record, so that a point look-up opens one bucket and a read doesn't grow with the
  number of calls;
* ``validation_runs`` -- an append-only log of opening values (the first one counts);
* ``quarantine`` -- results that can't be stored, or that name another record, with reasons.

``pending`` names calls whose parts aren't filed by record yet: readers add those parts, and the
next call of the run files them.
"""

from __future__ import annotations

import datetime as _dt
import urllib.parse
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.functions import text
from casegauge.operators import report, score, similar, standards, store
from casegauge.session import scratch_path
from casegauge.sources import codemaps, files
from casegauge.sources.buckets import BucketTable

RECORDS, RUNS, FACTS = "test_cases", "validation_runs", "score_facts"
CURRENT, HISTORY, COUNTERS = "current_scores", "score_history", "run_counters"
QUARANTINE, PENDING, INDEXED = "quarantine", "pending", "_indexed"
# report folders under an output directory: screened reports and validation reports
SCREEN_REPORTS, VALIDATION_REPORTS = "screening_reports", "validation_reports"
# the screened rows themselves (Parquet); the CSV reports are exports of them
SCREEN_TABLES = "screening_tables"

RECORD_CONTENT = store.RECORD_CONTENT
RECORD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (
    "case_id", *RECORD_CONTENT, "first_seen_at", "last_updated_at")])
# stores of older versions hold an append-only log of record snapshots (one part per call)
RECORD_LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (
    "case_id", *RECORD_CONTENT, "seen_at", "version")])
RECORD_ROWS = T.StructType([*RECORD_SCHEMA.fields, T.StructField("version", T.StringType())])
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("provider", T.StringType()),
    T.StructField("model", T.StringType()), T.StructField("total_cases", T.LongType()),
    T.StructField("passed_count", T.LongType()), T.StructField("needs_improvement_count", T.LongType()),
    T.StructField("failed_count", T.LongType()), T.StructField("error_count", T.LongType()),
    T.StructField("run_at", T.StringType())])
# the runs table is stored as an append-only log of run snapshots (one per call)
RUN_LOG_SCHEMA = T.StructType(RUN_SCHEMA.fields + [
    T.StructField("seen_at", T.StringType()), T.StructField("version", T.StringType())])
RUN_OPENING = ("provider", "model", "total_cases", "run_at")
RUN_COUNTERS = ("passed_count", "needs_improvement_count", "failed_count", "error_count")
FACT_SCHEMA = T.StructType([
    T.StructField("score_id", T.StringType()), T.StructField("case_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("preconditions_passed", T.BooleanType()), T.StructField("preconditions_remarks", T.StringType()),
    T.StructField("test_steps_passed", T.BooleanType()), T.StructField("test_steps_remarks", T.StringType()),
    T.StructField("expected_results_passed", T.BooleanType()),
    T.StructField("expected_results_remarks", T.StringType()),
    T.StructField("verdict", T.StringType()), T.StructField("overall_remarks", T.StringType()),
    T.StructField("improvements", T.StringType()), T.StructField("validated_at", T.StringType()),
    T.StructField("reply_case_id", T.StringType())])


FACT_ROWS = T.StructType([*FACT_SCHEMA.fields, T.StructField("row_key", T.StringType())])
COUNTER_SCHEMA = T.StructType([T.StructField("run_id", T.StringType()), *[
    T.StructField(c, T.LongType()) for c in RUN_COUNTERS]])
QUARANTINE_SCHEMA = T.StructType([*[T.StructField(c, T.StringType()) for c in (
    "run_id", "case_id", "reply_case_id", "reason")], T.StructField("stored", T.BooleanType()),
    T.StructField("raw", T.StringType())])


# ------------------------------------------------------------------ versioned tables -----

def upgrade_store_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """S12 for the store: a table written by an older version, brought to ``schema``.
    Score rows without a verdict take it from the legacy pass flag (1 -> Passed, 0 ->
    Failed); runs stored before the needs-improvement counter existed count 0 there; any
    other missing column is NULL and columns no longer used are dropped."""
    cols = set(df.columns)
    out = df
    if "overall_passed" in cols and "verdict" in schema.fieldNames():
        legacy = F.col("overall_passed").cast("int")
        backfill = F.when(legacy == 1, F.lit("Passed")).when(legacy == 0, F.lit("Failed"))
        current = F.col("verdict") if "verdict" in cols else F.lit(None).cast("string")
        out = out.withColumn("verdict", F.coalesce(current, backfill))
        cols.add("verdict")
    if "needs_improvement_count" in schema.fieldNames() and "run_id" in cols:
        current = (F.col("needs_improvement_count") if "needs_improvement_count" in cols
                   else F.lit(None))
        out = out.withColumn("needs_improvement_count", F.coalesce(current.cast("long"), F.lit(0)))
        cols.add("needs_improvement_count")
    return out.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType)
                        .alias(f.name) for f in schema.fields])


def _read_store(spark: SparkSession, path: str, schema: T.StructType,
                extra: T.StructType | None = None) -> DataFrame:
    """A folder of parts. Parts of this version have the fixed schema; only a store that an older
    version began (no ``_indexed`` mark) has its parts' schemas merged."""
    if not files.holds_parts(spark, path):  # no table yet
        return spark.createDataFrame([], schema)
    reader = spark.read.option("recursiveFileLookup", True)
    if extra is not None:
        return reader.schema(extra).parquet(path).select(*schema.fieldNames())
    return upgrade_store_table(reader.option("mergeSchema", True).parquet(path), schema)


def _indexed(spark: SparkSession, base: str) -> bool:
    """Whether the facts are filed by record (a store of an older version: at its next call)."""
    return INDEXED in files.listed(spark, base, folders=False) or \
        not files.holds_parts(spark, f"{base}/{FACTS}")


def read_runs(spark: SparkSession, base: str) -> DataFrame:
    """S7 + U3/U4 on read: the runs table (``RUN_SCHEMA``) -- a run's opening values (provider,
    model, total, opening time) are those of its first snapshot (insert-if-absent, N10); its
    counters are the sum of its parts' own counts (G6), on top of the newest snapshot's
    counters where an older version stored them. No score is read. Concurrent calls only
    append, so none can drop another run's row."""
    log = _read_store(spark, f"{base}/{RUNS}", RUN_LOG_SCHEMA,
                      RUN_LOG_SCHEMA if _current_parts(spark, base) else None)
    order = F.struct("seen_at", "version")
    counted = F.when(F.col("passed_count").isNotNull(), F.struct(*RUN_COUNTERS))
    agg = log.groupBy("run_id").agg(
        F.min_by(F.struct(*RUN_OPENING), order).alias("o"),
        F.max_by(counted, F.when(counted.isNotNull(), order)).alias("c"))
    parts = _read_store(spark, f"{base}/{COUNTERS}", COUNTER_SCHEMA, COUNTER_SCHEMA) \
        .groupBy(F.col("run_id").alias("__run")).agg(*[F.sum(c).alias(f"__{c}") for c in RUN_COUNTERS])
    zero = F.lit(0).cast("long")
    return agg.join(parts, F.col("run_id") == F.col("__run"), "left").select(
        "run_id", *[F.col(f"o.{c}").alias(c) for c in ("provider", "model", "total_cases")],
        *[(F.coalesce(F.col(f"c.{c}"), zero) + F.coalesce(F.col(f"__{c}"), zero)).alias(c)
          for c in RUN_COUNTERS], F.col("o.run_at"))


def append_run(df: DataFrame, base: str, stamp: str) -> str:
    path = f"{base}/{RUNS}/part={stamp}-{uuid.uuid4().hex[:8]}"
    df.write.mode("error").parquet(path)
    return path


def _run_folder(run_id: str) -> str:
    return "run=" + urllib.parse.quote(run_id, safe="")


def read_facts(spark: SparkSession, base: str, run_id: str | None = None) -> DataFrame:
    """S7 + S12 for the score facts: every appended part -- or, with ``run_id``, only that
    run's parts, read by path so no other run's file is listed or opened (an empty table
    before the first run). Parts of an older version are upgraded to the current schema.

    Facts are append-only: each call writes its new rows as one more part folder under
    its run and nothing already stored is rewritten, so the cost of a run is its own rows,
    however large the history.
    """
    extra = FACT_SCHEMA if _current_parts(spark, base) else None
    if run_id is None:
        return _read_store(spark, f"{base}/{FACTS}", FACT_SCHEMA, extra)
    facts = _read_store(spark, f"{base}/{FACTS}/{_run_folder(run_id)}", FACT_SCHEMA, extra)
    # the oldest stores filed no parts under runs
    old = [] if extra else [d for d in files.listed(spark, f"{base}/{FACTS}", folders=True)
                            if d.startswith("part=")]
    for d in old:
        facts = facts.unionByName(_read_store(spark, f"{base}/{FACTS}/{d}", FACT_SCHEMA))
    return facts.where(F.col("run_id") == run_id)


def _current_parts(spark: SparkSession, base: str) -> bool:
    """Whether all parts of the store were written by this version."""
    marks = files.listed(spark, base, folders=False)
    return INDEXED in marks and "_legacy" not in marks


def _merge_records(rows: DataFrame) -> DataFrame:
    """U2 by merge: per record the content of its newest snapshot, first and last time seen."""
    order = F.struct("last_updated_at", "version")
    return rows.groupBy("case_id").agg(
        F.max_by(F.struct(*RECORD_CONTENT), order).alias("v"),
        F.min("first_seen_at").alias("first_seen_at"), F.max(order).alias("o")).select(
        "case_id", *[F.col(f"v.{c}").alias(c) for c in RECORD_CONTENT], "first_seen_at",
        F.col("o.last_updated_at").alias("last_updated_at"), F.col("o.version").alias("version"))


def _merge_latest(rows: DataFrame) -> DataFrame:
    """Each record's newest scores (ties kept), each stored row once."""
    return store.latest_per_key(rows).dropDuplicates(["case_id", "row_key"])


def _records(spark: SparkSession, base: str) -> BucketTable:
    return BucketTable(spark, f"{base}/{RECORDS}", "case_id", RECORD_ROWS, _merge_records)


def _current(spark: SparkSession, base: str) -> BucketTable:
    return BucketTable(spark, f"{base}/{CURRENT}", "case_id", FACT_ROWS, _merge_latest)


def _history(spark: SparkSession, base: str) -> BucketTable:
    return BucketTable(spark, f"{base}/{HISTORY}", "case_id", FACT_ROWS,
                       lambda rows: rows.dropDuplicates(["case_id", "row_key"]))


def read_records(spark: SparkSession, base: str) -> DataFrame:
    """S7 + U2: the record table -- per record, the content of its newest snapshot, the
    time it was first seen and last updated (``RECORD_SCHEMA``); an empty table before the
    first run. The snapshot log of an older version is merged in."""
    table = _records(spark, base)
    old = [f"{base}/{RECORDS}/{d}" for d in files.listed(spark, table.path, folders=True)
           if d.startswith("part=")]
    if not old:
        return table.read().select(*RECORD_SCHEMA.fieldNames())
    log = upgrade_store_table(spark.read.option("mergeSchema", True).parquet(*old),
                              RECORD_LOG_SCHEMA)
    log = log.withColumn("first_seen_at", F.col("seen_at")).withColumnRenamed(
        "seen_at", "last_updated_at").select(*RECORD_ROWS.fieldNames())
    return _merge_records(table.rows().drop("bucket").unionByName(log)) \
        .select(*RECORD_SCHEMA.fieldNames())


def append_records(df: DataFrame, base: str, stamp: str) -> None:
    """Record snapshots (``case_id``, the content, ``seen_at``, ``version``) as one delta."""
    rows = df.withColumn("first_seen_at", F.col("seen_at")).withColumnRenamed(
        "seen_at", "last_updated_at").dropDuplicates(["case_id"])
    _records(df.sparkSession, base).append(rows, f"{stamp}-{uuid.uuid4().hex[:8]}")


def append_facts(df: DataFrame, base: str, part: str, run_id: str) -> str:
    """One part of a run's facts. Its tasks' files stand as soon as each task is done (commit
    version 2), so what a failed call has scored is stored, and a resumed run skips it."""
    path = f"{base}/{FACTS}/{_run_folder(run_id)}/part={part}"
    df.write.mode("error").option("mapreduce.fileoutputcommitter.algorithm.version", "2") \
        .parquet(path)
    return path


# ------------------------------------------------------------------ filing by record -----

def _mark(spark: SparkSession, path: str, on: bool = True) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if on:
        fs.create(at, True).close()
    else:
        fs.delete(at, False)


def _parts_of(spark: SparkSession, base: str, run: str, call: str | None = None) -> list[str]:
    """Paths of a run folder's parts that hold files (those of one call)."""
    top = f"{base}/{FACTS}/{run}"
    return [f"{top}/{d}" for d in files.listed(spark, top, folders=True)
            if d.startswith(f"part={call or ''}") and files.holds_parts(spark, f"{top}/{d}")]


def _pending(spark: SparkSession, base: str, run_id: str | None = None) -> list[tuple[str, str]]:
    """(run folder, call) of the calls whose parts aren't filed by record."""
    marks = files.listed(spark, f"{base}/{PENDING}", folders=False)
    found = [tuple(m.rsplit("~", 1)) for m in marks if "~" in m and not m.startswith(".")]
    return [m for m in found if run_id is None or m[0] == _run_folder(run_id)]


def _unfiled(spark: SparkSession, base: str) -> DataFrame:
    """Stored facts that aren't filed by record yet, as rows of the bucket tables."""
    if _indexed(spark, base):
        paths = [p for run, call in _pending(spark, base) for p in _parts_of(spark, base, run, call)]
        if not paths:
            return spark.createDataFrame([], FACT_ROWS)
        facts = spark.read.schema(FACT_SCHEMA).parquet(*paths)
    else:
        facts = read_facts(spark, base)
    return facts.withColumn("row_key", F.concat(
        F.lit("unfiled:"), F.monotonically_increasing_id().cast("string")))


def _count_part(spark: SparkSession, base: str, run: str, part: str, facts: DataFrame) -> None:
    """A part's own counts beside the others of its run (the same part again replaces
    them), and N8: its replies that name another record into the quarantine."""
    odd = F.col("reply_case_id") != F.col("case_id")
    counts = facts.groupBy("run_id").agg(*store.verdict_counts(F.col("verdict")),
                                         F.count_if(F.coalesce(odd, F.lit(False))).alias("odd"))
    found = counts.collect()  # one row: a part belongs to one run
    spark.createDataFrame([tuple(r)[:-1] for r in found], COUNTER_SCHEMA).coalesce(1) \
        .write.mode("overwrite").parquet(f"{base}/{COUNTERS}/{run}/part={part}")
    if any(r["odd"] for r in found):
        lost = facts.where(odd).select(
            "run_id", "case_id", "reply_case_id", F.lit("reply names another record").alias("reason"),
            F.lit(True).alias("stored"), F.lit(None).cast("string").alias("raw"))
        lost.write.mode("overwrite").parquet(f"{base}/{QUARANTINE}/{run}/part={part}")


def _file_call(spark: SparkSession, base: str, run: str, call: str) -> None:
    """File the parts of a call by record, count those that a crash left uncounted, and drop the
    call's mark. The same again changes nothing."""
    paths = _parts_of(spark, base, run, call)
    counted = files.listed(spark, f"{base}/{COUNTERS}/{run}", folders=True)
    for path in paths:
        name = path.rsplit("part=", 1)[-1]
        if f"part={name}" not in counted:
            _count_part(spark, base, run, name, spark.read.schema(FACT_SCHEMA).parquet(path))
    if paths:
        rows = spark.read.schema(FACT_SCHEMA).parquet(*paths)
        for table in (_history(spark, base), _current(spark, base)):
            table.append(rows, call, unique=True)
    _mark(spark, f"{base}/{PENDING}/{run}~{call}", on=False)


def _open_store(spark: SparkSession, base: str, run_id: str) -> None:
    """Before a call writes: a store of an older version is filed by record once, and what a
    failed call of the run left is filed."""
    if not _indexed(spark, base):
        rows = read_facts(spark, base)
        for table in (_history(spark, base), _current(spark, base)):
            table.append(rows, "legacy", unique=True)
        _mark(spark, f"{base}/_legacy")
    _mark(spark, f"{base}/{INDEXED}")
    for run, call in _pending(spark, base, run_id):
        _file_call(spark, base, run, call)


def read_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """Results that couldn't be stored, and stored ones that name another record."""
    return _read_store(spark, f"{base}/{QUARANTINE}", QUARANTINE_SCHEMA, QUARANTINE_SCHEMA)


# ------------------------------------------------------------------ pipeline stages ------

def generate_endpoint_file(spark: SparkSession, csv_path: str, out_dir: str,
                           base_url: str = text.DEFAULT_API_BASE) -> tuple[str, DataFrame]:
    """Ids + links -> endpoint CSV named after the input stem; returns the
    output folder and the rejected rows (links without an id)."""
    src = files.read_csv(spark, csv_path, required=files.SOURCE_REQUIRED)
    ok, rejected = files.endpoints_from_source(src, base=base_url)
    stem = csv_path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    out = f"{out_dir.rstrip('/')}/{stem}-endpoint"
    files.csv_writer(ok.write.mode("overwrite")).csv(out)
    return out, rejected


def build_links_file(spark: SparkSession, csv_path: str, out_dir: str,
                     base_url: str = text.DEFAULT_VIEW_BASE) -> tuple[str, DataFrame]:
    """An id-only CSV enriched with the link column right after ``ID`` (the
    file is left as it is when the column already exists), written as
    ``<name>_with_links``. Returns the output folder and the enriched DataFrame."""
    src = files.read_csv(spark, csv_path, required=("ID",))
    enriched = files.add_link_column(src, base=base_url)
    name = csv_path.rstrip("/").rsplit("/", 1)[-1].replace(".csv", "_with_links.csv")
    out = f"{out_dir.rstrip('/')}/{name.rsplit('.', 1)[0]}"
    files.csv_writer(enriched.write.mode("overwrite")).csv(out)
    return out, enriched


def run_pipeline(spark: SparkSession, source_csv: str, responses_path: str, output_dir: str,
                 run_ts: str | None = None, maps_path: str | None = None) -> dict:
    """The screening run end to end: id list -> endpoint file -> what each endpoint's
    fetch gave (from the landed responses) -> screened report snapshot. Returns the paths,
    the report, the per-endpoint fetch status, the rejected id rows, the totals, and the
    quarantine as stored under ``output_dir/quarantine`` (S6 P3: unreadable lines and rejected
    links, with ``reason``, ``ID`` and ``raw`` text)."""
    endpoint_dir, rejected = generate_endpoint_file(spark, source_csv,
                                                    f"{output_dir.rstrip('/')}/endpoints")
    env, torn = files.read_responses(spark, responses_path)
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    quarantine = files.write_quarantine(torn, rejected, f"{output_dir.rstrip('/')}/{QUARANTINE}",
                                        run_ts)
    endpoints = files.read_csv(spark, endpoint_dir, required=("ID", "endpoint"))
    status = files.fetch_status(endpoints, env)
    path, rep, totals = save_all_cases(spark, responses_path, output_dir, run_ts=run_ts,
                                       maps_path=maps_path)
    return {"endpoint_file": endpoint_dir, "rejected": rejected, "fetch_status": status,
            "report_path": path, "report": rep, "totals": totals,
            "quarantine": files.read_quarantine(spark, quarantine)}


def save_all_cases(spark: SparkSession, responses_path: str, output_dir: str,
                   run_ts: str | None = None, maps_path: str | None = None
                   ) -> tuple[str | None, DataFrame, dict]:
    """Landed fetch results -> screened, ordered
    report snapshot. The rows are screened once, into a Parquet table; the report is read from
    it, and sorted only for the CSV export. Returns the export's path (None when no fetch
    succeeded: then nothing is written), the report DataFrame and the run's totals ``{total,
    passed, failed}``.

    ``maps_path``: the code-dictionary JSON (``field_maps`` / ``retrieval_fields``
    sections). Its tribe / product / capability maps decode those report columns (without
    it they stay empty, as with empty retrieval dictionaries), and its standards maps
    replace the fixed ones in the rules and the decoded columns.

    The totals are an ``Observation`` on the rows being written: they are counted in the
    same pass as the write, not by a second job over the report.
    """
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    env, _ = files.read_responses(spark, responses_path)  # run_pipeline stores the rest
    recs = files.fetched_records(env)
    labels, maps = {}, codemaps.SMALL_MAPS
    if maps_path:
        dictionary = codemaps.load_dimension(spark, maps_path)
        maps = codemaps.standards_maps(dictionary)
        recs = codemaps.decode_retrieval_fields(recs, dictionary)
        labels = {label.lower(): F.col(f"__label_{label}")
                  for _, _, label in codemaps.RETRIEVAL_FIELDS}
    rep = standards.flatten(recs, **labels, maps=maps).select(*standards.REPORT_COLUMNS)
    if recs.isEmpty():
        # nothing fetched: no snapshot, so the newest report stays the previous one
        return None, rep, {"total": 0, "passed": 0, "failed": 0}
    obs = Observation("screen-totals")
    passed = F.count_if(F.coalesce(F.col("`General Standards`") == "Passed", F.lit(False)))
    observed = rep.observe(obs, F.count(F.lit(1)).alias("total"), passed.alias("passed"))
    base = output_dir.rstrip("/")
    table = files.write_snapshot(observed, f"{base}/{SCREEN_TABLES}", run_ts)
    rep = standards.report_order(spark.read.schema(rep.schema).parquet(table))
    path = files.write_snapshot(rep, f"{base}/{SCREEN_REPORTS}", run_ts, fmt="csv")
    got = obs.get
    totals = {"total": got["total"], "passed": got["passed"],
              "failed": got["total"] - got["passed"]}
    return path, rep, totals


def fetch_passed_cases(spark: SparkSession, output_dir: str) -> DataFrame:
    """Passed rows of the newest report snapshot, read from its Parquet table;
    from the CSV where there is only that (a report of an older version)."""
    base = output_dir.rstrip("/")
    newest = files.latest_snapshot_path(spark, f"{base}/{SCREEN_REPORTS}")
    name = newest.rsplit("run_ts=", 1)[-1] if newest else None
    table = f"{base}/{SCREEN_TABLES}/run_ts={name}"
    if name and files.holds_parts(spark, table):
        report_rows = files.require_columns(spark.read.parquet(table), files.REPORT_REQUIRED)
    else:
        report_rows = files.read_latest_report(spark, f"{base}/{SCREEN_REPORTS}", fmt="csv")
    return standards.passed_only(report_rows)


def _passed_as_records(passed: DataFrame) -> DataFrame:
    c = F.col
    return passed.select(
        c("`Test Case ID`").alias("case_id"), c("Title").alias("title"),
        c("`Project Initiative`").alias("project_initiative") if "Project Initiative" in passed.columns
        else F.lit(None).cast("string").alias("project_initiative"),
        *[(c(f"`{n}`") if n in passed.columns else F.lit(None).cast("string")).alias(a)
          for n, a in (("Tribe", "tribe"), ("Product", "product"), ("Capability", "capability"))],
        c("`Pre Conditions`").alias("pre_conditions"), c("`Test Steps`").alias("test_steps"),
        c("`Expected Result`").alias("expected_result"),
        *[(c(f"`{n}`") if n in passed.columns else F.lit(None).cast("string")).alias(a)
          for n, a in (("Testing Type", "testing_type"), ("Testing Phase", "testing_phase"))])


def init_validation_run(spark: SparkSession, store_base: str, run_id: str, provider: str,
                        model: str, total_cases: int, now: str | None = None,
                        version: str | None = None) -> None:
    """Open a run. Safe to repeat: the opening values of the first call stay (N10), and what
    a failed call of the run scored is filed and counted."""
    now = now or _dt.datetime.now(_dt.timezone.utc).isoformat()
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    _open_store(spark, store_base, run_id)
    opening = spark.createDataFrame(
        [(run_id, provider, model, total_cases, *[None] * len(RUN_COUNTERS), now, now, version)],
        RUN_LOG_SCHEMA)
    append_run(opening.coalesce(1), store_base, version)


def get_completed_case_ids(spark: SparkSession, store_base: str, run_id: str) -> DataFrame:
    """The ids already scored in a run (resume)."""
    return store.completed_ids(read_facts(spark, store_base, run_id), run_id)


def _fact_rows(rows: DataFrame, run_id: str, now: str) -> DataFrame:
    """``FACT_SCHEMA`` (and ``title``) from the 11 report columns, and ``case_id`` where the
    report shows another id than the record's."""
    c = F.col
    case_id = (c("case_id") if "case_id" in rows.columns else c("`Test Case ID`")).cast("string")
    return rows.select(
        F.sha2(F.concat_ws("|", F.lit(run_id), case_id), 256).alias("score_id"),
        case_id.alias("case_id"), F.lit(run_id).alias("run_id"),
        c("`Preconditions Passed`").alias("preconditions_passed"),
        c("`Preconditions Remarks`").alias("preconditions_remarks"),
        c("`Test Steps Passed`").alias("test_steps_passed"),
        c("`Test Steps Remarks`").alias("test_steps_remarks"),
        c("`Expected Results Passed`").alias("expected_results_passed"),
        c("`Expected Results Remarks`").alias("expected_results_remarks"),
        c("Verdict").alias("verdict"), c("`Overall Remarks`").alias("overall_remarks"),
        c("Improvements").alias("improvements"), F.lit(now).alias("validated_at"),
        c("`Test Case ID`").alias("reply_case_id"), c("Title").alias("title"))


def _snapshots(cases: DataFrame, now: str, version: str) -> DataFrame:
    return cases.select("case_id", *RECORD_CONTENT, F.lit(now).alias("seen_at"),
                        F.lit(version).alias("version"))


def save_case_result(spark: SparkSession, store_base: str, cases: DataFrame, rows: DataFrame,
                     run_id: str, now: str | None = None, version: str | None = None) -> None:
    """Store the results of some records of an open run: record snapshots, scores
    not stored yet, and their counts. ``cases``: ``case_id`` and the record columns; ``rows``:
    the 11 report columns, and ``case_id`` where the report shows another id than the
    record's. Results whose record is neither among ``cases`` nor stored, or whose run isn't
    open, go to the quarantine (:func:`read_quarantine`) instead, as JSON.

    Snapshots come before the scores: a crash in between leaves snapshots whose repeat the
    merge absorbs; the scores are what a resumed run skips.
    """
    now = now or _dt.datetime.now(_dt.timezone.utc).isoformat()
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    call = f"{version}-{uuid.uuid4().hex[:8]}"
    _open_store(spark, store_base, run_id)
    facts = _fact_rows(rows, run_id, now)
    run = _run_folder(run_id)
    opened = not read_runs(spark, store_base).where(F.col("run_id") == run_id).isEmpty()
    known = cases.select("case_id").unionByName(read_records(spark, store_base).select("case_id")) \
        .where("case_id is not null").distinct()
    lost = facts if not opened else facts.join(known, "case_id", "left_anti")
    lost = lost.select(
        "run_id", "case_id", "reply_case_id",
        F.lit("unknown record" if opened else "unknown run").alias("reason"),
        F.lit(False).alias("stored"), F.to_json(F.struct(*facts.columns)).alias("raw"))
    lost.write.mode("overwrite").parquet(f"{store_base}/{QUARANTINE}/{run}/part={call}-lost")
    if not opened:
        return
    append_records(_snapshots(cases, now, version), store_base, version)
    new = store.append_new(read_facts(spark, store_base, run_id),
                           facts.join(known, "case_id", "left_semi"), ["run_id", "case_id"])
    _mark(spark, f"{store_base}/{PENDING}/{run}~{call}")
    path = append_facts(new, store_base, call, run_id)
    _count_part(spark, store_base, run, call, spark.read.schema(FACT_SCHEMA).parquet(path))
    _file_call(spark, store_base, run, call)


def save_validation_run(spark: SparkSession, store_base: str, cases: DataFrame, rows: DataFrame,
                        run_id: str, provider: str, model: str, now: str | None = None) -> None:
    """A whole finished run stored in one call."""
    init_validation_run(spark, store_base, run_id, provider, model, rows.count(), now)
    save_case_result(spark, store_base, cases, rows, run_id, now)


def read_latest(spark: SparkSession, store_base: str) -> DataFrame:
    """Every record's latest scores (ties kept), from the table that holds just those."""
    table = _current(spark, store_base)
    return _merge_latest(table.rows().drop("bucket").unionByName(_unfiled(spark, store_base))) \
        .select(*FACT_SCHEMA.fieldNames())


def _scored_records(spark: SparkSession, store_base: str) -> DataFrame:
    """The records that a verdict is stored for, with their latest score: the example pool."""
    records = read_records(spark, store_base)
    latest = store.latest_per_key(read_latest(spark, store_base), dedup=True,
                                  tie_break=["score_id"])
    from_score = [c for c in similar.EXAMPLE_DETAILS if c not in records.columns]
    return records.join(latest.where(F.col("verdict").isNotNull())
                        .select("case_id", "verdict", *from_score), "case_id", "inner")


def get_few_shots(spark: SparkSession, store_base: str, cases: DataFrame, target: int = 5,
                  min_per_level: int = 3, seed: str = "seed") -> DataFrame:
    """Similar scored examples from the store for every record of ``cases`` (``case_id``,
    capability, product, tribe), with the examples' details."""
    return similar.similar_examples(cases.dropDuplicates(["case_id"]),
                                    _scored_records(spark, store_base), target, min_per_level,
                                    seed, carry=similar.EXAMPLE_DETAILS)


def _waves(spark: SparkSession, todo: DataFrame, n: int) -> Iterator[DataFrame]:
    """The records in ``n`` waves by id hash. Several waves are read from a scratch copy filed by
    wave, so that each reads its own files only."""
    if n <= 1:
        yield todo
        return
    path = scratch_path(spark, "todo")
    part = F.pmod(F.xxhash64("case_id"), F.lit(n)).cast("int")
    todo.withColumn("__part", part).write.partitionBy("__part").parquet(path)
    schema = T.StructType([*todo.schema.fields, T.StructField("__part", T.IntegerType())])
    staged = spark.read.schema(schema).parquet(path)
    for i in range(n):
        yield staged.where(F.col("__part") == i).drop("__part")


def validate_cases(spark: SparkSession, passed: DataFrame, store_base: str,
                   evaluator: score.Evaluator | None = None, run_id: str | None = None,
                   provider: str = "rule-screen", model: str = "standards-v1",
                   target: int = 5, min_per_level: int = 3, now: str | None = None,
                   parallelism: int | None = None, output_dir: str | None = None,
                   standards: str | None = None, instructions: str = "",
                   part_size: int = 10_000) -> tuple[DataFrame, dict]:
    """Score the passed records of a report and persist
    the run. Resumable: records already scored in ``run_id`` are skipped (anti join).
    Context examples come from the store as it was when the run started.

    One job scores and stores: its tasks hold about ``part_size`` records each, and a task's
    scores stand as soon as it is done, so a crash costs the tasks at work only and the resumed
    run skips the others. The evaluator runs once per record; the counts and the returned rows
    are read from what was stored. ``parallelism`` bounds the tasks that call the evaluator at
    once (a service's rate limit): then records go in waves of so many tasks, a part each. An id
    that stands several times is scored, stored and returned as often. Returns the 11-column
    result rows of this call (the id is the one in the evaluator's reply, or the request's
    on an error row) and verdict counters. With ``output_dir`` the run's CSV snapshot is written
    under ``output_dir/validation_reports`` from the store -- the whole run, also after a
    resume (N9) -- and the counters are that report's; without it they are this call's.
    With ``standards`` (the standards document's text, see ``files.read_standards``) the
    evaluator also receives each record's ``prompt`` (``score.evaluation_prompt``).
    """
    # one UTC timestamp per call, a literal in every plan (reruns stay reproducible)
    now = now or _dt.datetime.now(_dt.timezone.utc).isoformat()
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    # the run is opened before anything is scored, so that scores stored by a call that
    # fails later belong to a known run
    init_validation_run(spark, store_base, run_id, provider, model, passed.count(), now, stamp)
    todo = store.remaining(_passed_as_records(passed), read_facts(spark, store_base, run_id))
    pools = similar.group_pools(_scored_records(spark, store_base), target, min_per_level, seed=run_id,
                                carry=similar.EXAMPLE_DETAILS)

    def scored_part(part: DataFrame) -> DataFrame:
        # a record's context depends on its id and groups: one context row per id, so that
        # repeated ids multiply nothing
        examples = similar.similar_examples(part.dropDuplicates(["case_id"]), None, target,
                                            min_per_level, seed=run_id, members=pools,
                                            carry=similar.EXAMPLE_DETAILS)
        work = part.join(similar.few_shot_context(examples), "case_id", "left")
        if standards is not None:
            # the prompt a remote evaluator sends (the standards document is one small
            # text, a literal in the plan)
            c = F.col
            work = work.withColumn("prompt", score.evaluation_prompt(
                F.lit(standards), c("context"), c("case_id"), c("title"), c("testing_type"),
                c("testing_phase"), c("pre_conditions"), c("test_steps"), c("expected_result"),
                instructions))
        if evaluator is None:
            out = score.rule_screen(work).withColumn("report_case_id", F.col("case_id"))
        else:
            out = score.score(work, evaluator, parallelism=parallelism, per_row=True,
                              carry=("title",))
        return out.select("case_id", "title", "evaluation", "report_case_id")

    count, run, call = todo.count(), _run_folder(run_id), f"{stamp}-{uuid.uuid4().hex[:8]}"
    if count:
        append_records(_snapshots(todo, now, stamp), store_base, stamp)
        _mark(spark, f"{store_base}/{PENDING}/{run}~{call}")
        tasks = -(-count // part_size)
        waves = -(-count // (part_size * parallelism)) if parallelism else 1
        for i, wave in enumerate(_waves(spark, todo, waves)):
            if not parallelism and tasks > 1:
                wave = wave.repartition(tasks, "case_id")
            report_rows = score.result_rows(scored_part(wave), id_col="report_case_id",
                                            keep=("case_id",))
            path = append_facts(_fact_rows(report_rows, run_id, now), store_base,
                                f"{call}.{i:05d}", run_id)
            _count_part(spark, store_base, run, f"{call}.{i:05d}",
                        spark.read.schema(FACT_SCHEMA).parquet(path))
        _file_call(spark, store_base, run, call)
    titled = T.StructType([*FACT_SCHEMA.fields, T.StructField("title", T.StringType())])
    paths = _parts_of(spark, store_base, run, call) if count else []
    mine = spark.read.schema(titled).parquet(*paths) if paths else spark.createDataFrame([], titled)
    rows = _report_columns(mine)
    verdict = F.col("Verdict")
    counters = [F.count(F.lit(1)).alias("total")] + [
        F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in (
            ("passed", verdict == "Passed"), ("needs_improvement", verdict == "Needs Improvement"),
            ("failed", verdict == "Failed"), ("errors", verdict.isNull()))]
    if output_dir:
        # The run's report is the whole run as stored, also after a resume
        report_rows = run_report(spark, store_base, run_id)
        obs = Observation("validation-counters")
        files.write_snapshot(report_rows.observe(obs, *counters),
                             f"{output_dir.rstrip('/')}/{VALIDATION_REPORTS}", run_id, fmt="csv")
        got = dict(obs.get)
    else:
        got = rows.agg(*counters).first().asDict()
    return rows, got


def run_report(spark: SparkSession, store_base: str, run_id: str) -> DataFrame:
    """The 11-column validation report of a whole run, from the stored scores (the
    id is the evaluator's reply id where one was stored) and the records' titles."""
    f = read_facts(spark, store_base, run_id)
    titles = read_records(spark, store_base).select("case_id", "title")
    return _report_columns(f.join(titles, "case_id", "left"))


def _report_columns(j: DataFrame) -> DataFrame:
    """Stored scores with their titles as the 11 report columns."""
    return j.select(
        F.coalesce(F.col("reply_case_id"), F.col("case_id")).alias("Test Case ID"),
        F.col("title").alias("Title"),
        F.col("preconditions_passed").alias("Preconditions Passed"),
        F.col("preconditions_remarks").alias("Preconditions Remarks"),
        F.col("test_steps_passed").alias("Test Steps Passed"),
        F.col("test_steps_remarks").alias("Test Steps Remarks"),
        F.col("expected_results_passed").alias("Expected Results Passed"),
        F.col("expected_results_remarks").alias("Expected Results Remarks"),
        F.col("verdict").alias("Verdict"),
        F.col("overall_remarks").alias("Overall Remarks"),
        F.col("improvements").alias("Improvements"))


def run_all(spark: SparkSession, source_csv: str, responses_path: str, output_dir: str,
            store_base: str, evaluator: score.Evaluator | None = None,
            run_id: str | None = None, maps_path: str | None = None, **validate_args) -> dict:
    """Screening run, then scoring of the newest report's passed records. With no passed
    record nothing is scored and no run is opened (``validation`` is None)."""
    screened = run_pipeline(spark, source_csv, responses_path, output_dir,
                            run_ts=run_id, maps_path=maps_path)
    passed = fetch_passed_cases(spark, output_dir)
    if passed.isEmpty():
        return {**screened, "validation": None}
    rows, counts = validate_cases(spark, passed, store_base, evaluator=evaluator, run_id=run_id,
                                  output_dir=output_dir, **validate_args)
    return {**screened, "validation": rows, "validation_counts": counts}


def latest_validation_report(spark: SparkSession, output_dir: str) -> DataFrame | None:
    """The saved validation report whose run name sorts last, upgraded to the
    current columns (old reports carry ``Overall Passed`` / ``Summary``); None if none."""
    base = f"{output_dir.rstrip('/')}/{VALIDATION_REPORTS}"
    try:
        df = files.read_latest_report(spark, base, fmt="csv", required=("Test Case ID",),
                                      by="name")
    except FileNotFoundError:
        return None
    return files.normalize_validation(df)


def get_all_cases(spark: SparkSession, store_base: str) -> DataFrame:
    """Every record with its latest score and run metadata."""
    return store.records_with_latest(
        read_records(spark, store_base), read_latest(spark, store_base),
        read_runs(spark, store_base)).orderBy("case_id")


def get_validation_runs(spark: SparkSession, store_base: str) -> DataFrame:
    """O3: run summaries, newest first."""
    return store.runs_newest_first(read_runs(spark, store_base))


def get_case_history(spark: SparkSession, store_base: str, case_id: str) -> DataFrame:
    """Every scoring attempt of one record, newest first; of the stored history
    only the record's bucket is opened."""
    mine = _history(spark, store_base).at(case_id).unionByName(
        _unfiled(spark, store_base).where(F.col("case_id") == case_id))
    return store.history(mine.select(*FACT_SCHEMA.fieldNames()), read_runs(spark, store_base))


def categorize_remark(remark):
    """the criterion that a remark (a column) belongs to."""
    return report.criterion_of_remark(remark)


def failure_breakdown(report_df: DataFrame) -> DataFrame:
    """G4 from a report's remark text (works on reports read back from CSV), with the
    report view's column names ``Criterion`` / ``Failed cases``."""
    return (report.failure_breakdown(report_df, compat=True, verdict_col="General Standards",
                                     remarks_col="Remarks")
            .withColumnRenamed("criterion", "Criterion")
            .withColumnRenamed("failed_cases", "Failed cases"))
