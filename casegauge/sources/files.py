"""File sources and sinks.

* CSV in: every column read as STRING from the header (ids never become floats),
  multi-line quoted fields, a required-column contract checked on the schema (no job).
* Landed fetch responses in: JSON lines with a fixed envelope schema; malformed lines go
  to a quarantine DataFrame instead of failing the job.
* Snapshots: reports are written under ``run_ts=yyyyMMdd_HHmmss`` folders; the newest is
  found from file metadata only (no data is read to pick it).
* Store tables: read as Parquet, or an empty DataFrame of the schema when absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.functions import text

# --- Fixed values: column contracts of the reference's files. ---
SOURCE_REQUIRED = ("ID", "Testrail Link")
REPORT_REQUIRED = ("General Standards", "Test Case ID", "Title", "Testing Type",
                   "Testing Phase", "Pre Conditions", "Test Steps", "Expected Result")
# --- end of fixed values ---

STEP = T.StructType([T.StructField("content", T.StringType()),
                     T.StructField("expected", T.StringType())])
RAW_RECORD = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("custom_project_initiative", T.StringType()),
    T.StructField("custom_case_tribe", T.IntegerType()),
    T.StructField("custom_product_prod", T.IntegerType()),
    T.StructField("custom_capability", T.IntegerType()),
    T.StructField("priority_id", T.IntegerType()),
    T.StructField("custom_automatability", T.IntegerType()),
    T.StructField("custom_automation_status", T.IntegerType()),
    T.StructField("custom_testing_type", T.IntegerType()),
    T.StructField("case_status_id", T.IntegerType()),
    T.StructField("custom_testing_phase", T.ArrayType(T.IntegerType())),
    T.StructField("custom_preconds", T.StringType()),
    T.StructField("custom_steps_separated", T.ArrayType(STEP)),
])
ENVELOPE = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("response", RAW_RECORD),
])


class ContractError(ValueError):
    pass


def require_columns(df: DataFrame, required) -> DataFrame:
    """Fail fast, naming every missing column (schema only; no Spark job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def csv_writer(writer):
    """Options of every CSV the package writes: a header, doubled quotes, and values as they
    are (by default the writer would trim their blanks)."""
    return (writer.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_csv(spark: SparkSession, path: str, required=()) -> DataFrame:
    """Header CSV, all columns as text, quoted multi-line fields, '' -> NULL."""
    df = (spark.read.option("header", True).option("multiLine", True)
          .option("escape", '"').option("inferSchema", False).csv(path))
    return require_columns(df, required)


def endpoints_from_source(source: DataFrame, link_col: str = "Testrail Link",
                          pattern: str = text.DEFAULT_LINK_PATTERN,
                          base: str = text.DEFAULT_API_BASE) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` -- endpoints for links with an id, and the rows
    whose link yields none (reported, never silently dropped)."""
    require_columns(source, ("ID", link_col))
    rid = text.extract_id(F.col(link_col), pattern)
    with_id = source.withColumn("__rid", rid)
    accepted = with_id.where(F.col("__rid").isNotNull()).select(
        "ID", text.endpoint(F.col("__rid"), base).alias("endpoint"))
    rejected = with_id.where(F.col("__rid").isNull()).select("ID", F.col(link_col).alias("link"))
    return accepted, rejected


def add_link_column(df: DataFrame, base: str = text.DEFAULT_VIEW_BASE,
                    link_col: str = "Testrail Link") -> DataFrame:
    """Insert the link right after ``ID``; a no-op when the column already exists."""
    require_columns(df, ("ID",))
    if link_col in df.columns:
        return df
    cols = []
    for c in df.columns:
        cols.append(F.col(f"`{c}`"))
        if c == "ID":
            cols.append(text.build_link(F.col("ID"), base).alias(link_col))
    return df.select(*cols)


CORRUPT_COL = "_unparsed_line"
_ENVELOPE_PARSE = T.StructType(ENVELOPE.fields + [T.StructField(CORRUPT_COL, T.StringType())])


def _landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed lines parsed by the scan itself with the envelope schema. A line that isn't
    a JSON object (torn, truncated, another JSON value) has its text in ``CORRUPT_COL`` and no
    field; an envelope whose fields have the wrong type keeps the fields that parsed (the others
    are NULL), as a record with a mistyped code is still screened -- and fails its rule. A
    line that holds an array of envelopes counts as those envelopes."""
    env = spark.read.schema(_ENVELOPE_PARSE).option("columnNameOfCorruptRecord", CORRUPT_COL) \
        .json(path)
    c = F.col
    nothing = c("ID").isNull() & c("status_code").isNull() & c("response").isNull()
    # the scan keeps the fields before a tear: only text that is JSON counts as mistyped
    torn = c(CORRUPT_COL).isNotNull() & (nothing | F.try_parse_json(CORRUPT_COL).isNull())
    return env.withColumn("torn", torn).withColumn("empty", _without_record(c("status_code"),
                                                                            c("response")))


def _without_record(status: Column, response: Column) -> Column:
    """A success (status 200) that holds no record: it can't be screened, nor count as failed."""
    return F.coalesce(status == 200, F.lit(False)) & response.isNull()


def read_responses(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landed fetch results (JSON lines ``{ID, status_code, response}``).

    Returns ``(envelopes, quarantine)``: envelopes as the scan parses them; lines that are
    unreadable, or a success without a record, land in the quarantine with their raw text
    instead of aborting the batch. The text of the latter is read by a scan of its own, which
    only the quarantine's reader runs.
    """
    env = _landed(spark, path)
    good = env.where(~F.col("torn") & ~F.col("empty")).select("ID", "status_code", "response")
    torn = env.where("torn").select(F.col(CORRUPT_COL).alias("line"))
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    parsed = F.from_json("line", T.ArrayType(ENVELOPE))
    empty = lines.where(F.exists(parsed, lambda e: _without_record(e["status_code"], e["response"])))
    return good, torn.unionByName(empty)


QUARANTINE = "reason string, ID string, raw string"


def write_quarantine(torn: DataFrame, rejected: DataFrame, base: str, run_ts: str) -> str:
    """Unreadable lines and rejected links of a run, with the reason and their text."""
    rows = torn.select(F.lit("unreadable line").alias("reason"),
                       F.lit(None).cast("string").alias("ID"), F.col("line").alias("raw"))
    return write_snapshot(rows.unionByName(rejected.select(
        F.lit("link without an id").alias("reason"), "ID", F.col("link").alias("raw"))), base, run_ts)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE).parquet(path)


def ingest_counts(spark: SparkSession, path: str) -> DataFrame:
    """G11 + quarantine in one pass over the landed lines: fetched ok (status 200), failed
    (another or no status) and quarantined (unreadable, or without a record)."""
    lost = F.col("torn") | F.col("empty")
    is_ok = F.coalesce(F.col("status_code") == 200, F.lit(False))
    return _landed(spark, path).agg(F.count_if(~lost & is_ok).alias("ok"),
                                    F.count_if(~lost & ~is_ok).alias("failed"),
                                    F.count_if(lost).alias("quarantined"))


def fetched_records(envelopes: DataFrame) -> DataFrame:
    """P5: keep successful fetches (status exactly 200) and unnest the record; a success
    without a record yields no row."""
    return envelopes.where((F.col("status_code") == 200) & F.col("response").isNotNull()) \
        .select("response.*")


def fetch_counts(envelopes: DataFrame) -> DataFrame:
    """Fetched ok / failed."""
    ok = F.coalesce(F.col("status_code") == 200, F.lit(False))
    return envelopes.agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"))


def fetch_status(endpoints: DataFrame, envelopes: DataFrame, id_col: str = "ID") -> DataFrame:
    """S5 / G11 per endpoint: ``ok`` (a 200 envelope), ``failed`` (only other or missing
    status codes) or ``not fetched`` (no parseable envelope: never landed, or its line
    went to the quarantine). Envelopes are reduced to one row per id first (partial
    aggregation: an id fetched again counts as ok if any attempt returned 200), so the
    join with the endpoint list is one-to-one."""
    per_id = (envelopes.groupBy(F.col("ID").alias("__id"))
              .agg(F.max(F.coalesce(F.col("status_code") == 200, F.lit(False))).alias("__ok")))
    j = endpoints.join(per_id, endpoints[id_col] == F.col("__id"), "left")
    status = (F.when(F.col("__id").isNull(), F.lit("not fetched"))
              .when(F.col("__ok"), F.lit("ok")).otherwise(F.lit("failed")))
    return j.select(*[endpoints[c] for c in endpoints.columns], status.alias("fetch_status"))


def write_snapshot(df: DataFrame, base: str, run_ts: str, fmt: str = "parquet") -> str:
    """Write one report snapshot under ``base/run_ts=...``; CSV gets a header
    and RFC-4180 quoting (Spark writes no BOM)."""
    path = f"{base.rstrip('/')}/run_ts={run_ts}"
    w = df.write.mode("overwrite")
    if fmt == "csv":
        csv_writer(w).csv(path)
    else:
        w.parquet(path)
    return path


def latest_snapshot_path(spark: SparkSession, base: str, by: str = "stamp") -> str | None:
    """The newest snapshot folder under ``base``. ``by="stamp"``: the newest
    ``yyyyMMdd_HHmmss`` stamp in the name (stamps that do not parse sort oldest);
    ``by="name"``: the name that sorts last (the last of the sorted file names). Lists the
    folders of ``base`` only, not what they hold; a folder without files is no snapshot. None
    when there is no snapshot or no ``base``."""
    names = [(d,) for d in listed(spark, base, folders=True) if d.startswith("run_ts=")]
    if not names:
        return None
    name = F.substring_index("dir", "run_ts=", -1)
    stamp = F.coalesce(text.file_timestamp(name), F.lit("0001-01-01").cast("timestamp"))
    newest_first = spark.createDataFrame(names, "dir string").orderBy(
        *([] if by == "name" else [stamp.desc()]), F.desc("dir"))
    for row in newest_first.toLocalIterator():
        path = f"{base.rstrip('/')}/{row['dir']}"
        if any(not f.startswith(("_", ".")) for f in listed(spark, path, folders=False)):
            return path
    return None


def listed(spark: SparkSession, path: str, folders: bool) -> list[str]:
    """The names of the folders (or the files) directly under ``path``; none if it doesn't exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() == folders]


def holds_parts(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds at least one written file (names with a leading ``_`` or
    ``.`` belong to writes that aren't finished). Stops at the first one found."""
    if any(not f.startswith(("_", ".")) for f in listed(spark, path, folders=False)):
        return True
    return any(holds_parts(spark, f"{path}/{d}") for d in listed(spark, path, folders=True)
               if not d.startswith(("_", ".")))


def read_latest_report(spark: SparkSession, base: str, fmt: str = "parquet",
                       required=REPORT_REQUIRED, by: str = "stamp") -> DataFrame:
    """S3 + S1/S2: newest report snapshot, contract-checked."""
    path = latest_snapshot_path(spark, base, by=by)
    if path is None:
        raise FileNotFoundError(f"no report snapshot under {base}")
    df = read_csv(spark, path) if fmt == "csv" else spark.read.parquet(path)
    return require_columns(df, required)



def read_standards(spark: SparkSession, path: str) -> DataFrame:
    """The written standards as one row of whole text."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("standards"))


def legacy_verdict(flag: Column, dtype: str) -> Column:
    """The legacy pass flag as a verdict: only true / 1 -> ``Passed`` and false / 0 ->
    ``Failed``; anything else (NULL, other numbers, other text) -> NULL. Text flags are
    the spellings a CSV reader takes as booleans (``true``/``True``/``TRUE`` ...), not
    every string Spark's boolean cast accepts (``yes``, ``t``, ``y``)."""
    if dtype == "boolean":
        ok = flag
    elif dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or \
            dtype.startswith("decimal"):
        ok = F.when(flag == 1, F.lit(True)).when(flag == 0, F.lit(False))
    else:
        t = F.lower(flag.cast("string"))
        ok = F.when(t.isin("true", "1", "1.0"), F.lit(True)).when(t.isin("false", "0", "0.0"),
                                                                     F.lit(False))
    return F.when(ok, F.lit("Passed")).when(~ok, F.lit("Failed"))


def normalize_validation(df: DataFrame) -> DataFrame:
    """Upgrade an old validation report to the current columns.

    ``Verdict`` from the legacy pass flag (True -> Passed, False -> Failed, NULL stays
    NULL); ``Overall Remarks`` from ``Summary`` (or ''); ``Improvements`` ''. Columns that
    already exist are kept as they are.
    """
    out = df
    if "Verdict" not in df.columns and "Overall Passed" in df.columns:
        out = out.withColumn("Verdict", legacy_verdict(F.col("`Overall Passed`"),
                                                       dict(df.dtypes)["Overall Passed"]))
    if "Overall Remarks" not in df.columns:
        out = out.withColumn("Overall Remarks",
                             F.col("Summary") if "Summary" in df.columns else F.lit(""))
    if "Improvements" not in df.columns:
        out = out.withColumn("Improvements", F.lit(""))
    return out
