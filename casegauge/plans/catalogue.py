"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the given tables (or relations Spark derives from them) in full; the
only limits are the ones that are the feature (first-k examples per record).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegauge.operators import report, standards
from casegauge.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


# ------------------------------------------------------------------ standards screen ----

@query("standards_eval")
def standards_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode + six rules + verdict/remarks per record (report columns)."""
    rep = standards.flatten(fx.cases_raw(fx.tables(spark, sf_dir)))
    return rep.select("General Standards", "Remarks", "Test Case ID", "Priority",
                      "Automatability", "Automation Status", "Testing Type", "Status",
                      "Testing Phase")


@query("passed_ordered")
def passed_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passing rows of the screen in report order."""
    rep = standards.flatten(fx.cases_raw(fx.tables(spark, sf_dir)))
    return standards.report_order(standards.passed_only(rep)).select(
        "Test Case ID", "General Standards", "Priority")


@query("report_positions")
def report_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: every row's position in the report -- Passed first, then the id as text."""
    rep = standards.flatten(fx.cases_raw(fx.tables(spark, sf_dir)))
    return standards.report_positions(rep.select("Test Case ID", "General Standards"))


@query("failure_breakdown")
def failure_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures per criterion over the whole screen."""
    ev = standards.evaluate(fx.cases_raw(fx.tables(spark, sf_dir)))
    return report.failure_breakdown(ev)


@query("failure_breakdown_compat")
def failure_breakdown_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 F4 (compat): criteria re-parsed from the remark text, as the reference does."""
    ev = standards.evaluate(fx.cases_raw(fx.tables(spark, sf_dir)))
    return report.failure_breakdown(ev, compat=True)


@query("report_totals")
def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total / passed / failed / pass rate of the screen."""
    ev = standards.evaluate(fx.cases_raw(fx.tables(spark, sf_dir)))
    return report.totals(ev, verdict_col="verdict")


# ------------------------------------------------------------------ store & reports ----

import datetime as dt  # noqa: E402

from casegauge import api  # noqa: E402
from casegauge.operators import store  # noqa: E402

FILTERS = dict(tribe="All", product="All", capability="All", verdict="Needs Improvement",
               start="2024-01-20", end="2024-01-31", search="customer#0+1")


def _latest_view(spark: SparkSession, sf_dir: str, runs: bool = False) -> DataFrame:
    """The latest view; with ``runs`` also provider and model."""
    t = fx.tables(spark, sf_dir)
    return store.records_with_latest(fx.cases(t), fx.scores(t), fx.runs(t) if runs else None)


@query("verdict_frequency")
def verdict_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each verdict was given over all scoring attempts."""
    return report.verdict_frequency(fx.scores(fx.tables(spark, sf_dir)))


@query("verdict_counters")
def verdict_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 (+N11): counters of the latest view; errors include never-scored records."""
    return report.verdict_counters(_latest_view(spark, sf_dir),
                                   never_scored=F.col("never_scored"))


@query("run_counters")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-run verdict counters in one grouped aggregate."""
    t = fx.tables(spark, sf_dir)
    return store.run_counters(fx.runs(t), fx.scores(t))


@query("latest_per_case")
def latest_per_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest score per record (ties kept)."""
    return store.latest_per_key(fx.scores(fx.tables(spark, sf_dir)))


@query("latest_with_ties")
def latest_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator where equal newest timestamps exist (orders per customer)."""
    o = fx.tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return store.latest_per_key(o, key="o_custkey", ts="o_orderdate")


@query("latest_dedup")
def latest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N7 dedup option: exactly one newest row per key, ties broken by the higher id."""
    o = fx.tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return store.latest_per_key(o, key="o_custkey", ts="o_orderdate", dedup=True,
                                tie_break=["o_orderkey"])


@query("cases_with_latest")
def cases_with_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its latest score and that score's run metadata."""
    return _latest_view(spark, sf_dir, runs=True).orderBy("case_id")


@query("case_history")
def case_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scoring attempt with run metadata, newest first per record."""
    t = fx.tables(spark, sf_dir)
    return store.history(fx.scores(t), fx.runs(t))


def _filed_scores(spark: SparkSession, sf_dir: str, name: str, merge) -> BucketTable:
    """The scores filed by record, in three deltas of which the first two are merged."""
    facts = fx.scores(fx.tables(spark, sf_dir))
    table = BucketTable(spark, scratch_path(spark, name), "case_id", facts.schema, merge, n=16)
    third = F.pmod("score_id", F.lit(3))
    for i in range(3):
        table.append(facts.where(third == i), f"p{i}")
        if i == 1:
            table.compact()
    return table


@query("case_point_history")
def case_point_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts of one record (the most often scored; ties to the smaller id),
    newest first, out of scores filed by record: one bucket is read."""
    t = fx.tables(spark, sf_dir)
    busiest = fx.scores(t).groupBy("case_id").count().orderBy(F.desc("count"), "case_id").first()
    table = _filed_scores(spark, sf_dir, "history", lambda rows: rows.dropDuplicates(["score_id"]))
    return store.history(table.at(busiest["case_id"] if busiest else -1), fx.runs(t))


@query("current_scores")
def current_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest score of every record (ties kept), out of the table that keeps just
    those, merged from deltas."""
    return _filed_scores(spark, sf_dir, "current", lambda rows: store.latest_per_key(rows).dropDuplicates(
        ["case_id", "score_id"])).read()


@query("completed_in_run")
def completed_in_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records scored in the newest run."""
    facts = fx.scores(fx.tables(spark, sf_dir))
    return store.completed_ids(facts, facts.agg(F.max("run_id")).first()[0])


@query("store_save_run")
def store_save_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run saved into a store that holds the others: its run row replaced, its
    records upserted with new content, its scores appended once. Returns all rows of the three
    tables, their columns as one text."""
    t = fx.tables(spark, sf_dir)
    facts, runs, cases = fx.scores(t), fx.runs(t), fx.cases(t)
    newest = F.col("run_id") == facts.agg(F.max("run_id")).first()[0]
    touched = cases.join(facts.where(newest).select("case_id").distinct(), "case_id", "left_semi") \
        .withColumn("title", F.concat("title", F.lit(" v2"))) \
        .withColumn("tribe", F.lit(None).cast("string"))
    stale = runs.withColumn("model", F.lit("standards-v0"))
    recs, rns, fcts = store.save_run(cases, stale, facts.where(~newest), touched,
                                     runs.where(newest), facts, keep_first=("product",))

    def shown(df: DataFrame, part: str, key: str) -> DataFrame:
        def plain(c: str, kind: str):
            col = F.col(c)
            if kind.startswith("timestamp"):
                col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
            return F.coalesce(col.cast("string"), F.lit("-"))
        return df.select(F.lit(part).alias("part"), F.col(key).cast("string").alias("id"),
                         F.concat_ws("|", *[plain(c, k) for c, k in df.dtypes if c != key])
                         .alias("content"))
    return shown(recs, "records", "case_id").unionByName(shown(rns, "runs", "run_id")) \
        .unionByName(shown(fcts, "scores", "score_id"))


@query("runs_newest_first")
def runs_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: run summaries with their counters, newest first."""
    t = fx.tables(spark, sf_dir)
    return store.runs_newest_first(store.run_counters(fx.runs(t), fx.scores(t)))


@query("facets")
def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct tribe / product / capability values of the latest view."""
    return report.facets(_latest_view(spark, sf_dir))


@query("date_extent")
def date_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last scoring date in the latest view."""
    return report.date_extent(_latest_view(spark, sf_dir), "validated_at")


@query("date_extent_fallback")
def date_extent_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records that were never scored have no dates, so the extent is the year before the
    given day."""
    never = _latest_view(spark, sf_dir).where("never_scored")
    return report.date_extent(never, "validated_at", today=dt.date(2024, 6, 1))


@query("empty_store")
def empty_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of a store that doesn't exist yet are empty; every record stands there
    unscored."""
    base = scratch_path(spark, "new-store")
    return store.records_with_latest(fx.cases(fx.tables(spark, sf_dir)), api.read_facts(spark, base),
                                     api.read_runs(spark, base)) \
        .select("case_id", "title", "verdict", "provider", "never_scored")


@query("filtered_view")
def filtered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All filters combined (All = off) over the latest view."""
    f = FILTERS
    v = _latest_view(spark, sf_dir)
    return report.apply_filters(
        v,
        report.verdict_filter(f["verdict"]),
        report.equals_unless_all("tribe", f["tribe"]),
        report.equals_unless_all("product", f["product"]),
        report.equals_unless_all("capability", f["capability"]),
        report.date_range("validated_at", dt.date.fromisoformat(f["start"]),
                          dt.date.fromisoformat(f["end"])),
        report.search(f["search"]),
    ).select("case_id", "title", "tribe", "product", "capability", "verdict", "validated_at")


@query("filtered_values")
def filtered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 P18 with real values: one tribe, latest verdict an error or none."""
    view = _latest_view(spark, sf_dir)
    return view.where(report.equals_unless_all("tribe", "EUROPE")) \
        .where(report.verdict_filter("Error")).select("case_id", "product", "never_scored")


@query("display_labels")
def display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Badges for verdicts and flags, dashes for blank metadata."""
    v = _latest_view(spark, sf_dir, runs=True)
    return v.select(
        "case_id",
        report.verdict_badge(F.col("verdict")).alias("verdict_label"),
        report.flag_badge(F.col("preconditions_passed")).alias("preconditions_label"),
        report.flag_badge(F.col("test_steps_passed")).alias("test_steps_label"),
        report.flag_badge(F.col("expected_results_passed")).alias("expected_results_label"),
        report.blank_as_dash(F.col("provider")).alias("provider_label"),
    )


# Market segments held by the older / newer record snapshot: keys only in the older one
# are kept, keys in both are updated (capability overwritten with NULL for accounts in
# debit), keys only in the newer one are inserted. Every customer is in one or both.
OLD_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")
NEW_SEGMENTS = ("FURNITURE", "HOUSEHOLD", "MACHINERY")


def _snapshots(spark: SparkSession, sf_dir: str):
    c = fx.tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment",
                                                   "c_acctbal")
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    old = c.where(seg.isin(*OLD_SEGMENTS)).select(
        k.alias("case_id"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("capability"),
        F.lit("2024-01-01T00:00:00+00:00").alias("first_seen_at"),
        F.lit("2024-01-01T00:00:00+00:00").alias("last_updated_at"))
    new = c.where(seg.isin(*NEW_SEGMENTS)).select(
        k.alias("case_id"), F.concat("c_name", F.lit(" v2")).alias("title"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(seg).alias("capability"),
        F.lit("2024-02-01T00:00:00+00:00").alias("first_seen_at"),
        F.lit("2024-02-01T00:00:00+00:00").alias("last_updated_at"))
    return old, new


def _run_snapshots(spark: SparkSession, sf_dir: str):
    s = fx.scores(fx.tables(spark, sf_dir))
    day = F.dayofmonth("validated_at")

    def runs_of(df, model):
        return (df.groupBy("run_id").agg(F.count(F.lit(1)).alias("total_cases"),
                                         F.min("validated_at").alias("run_at"))
                .select("run_id", F.lit(fx.PROVIDER).alias("provider"),
                        F.lit(model).alias("model"), "total_cases", "run_at"))
    return runs_of(s.where(day <= 20), "standards-v1"), runs_of(s.where(
        ~F.coalesce(day < 15, F.lit(False))), "standards-v2")


@query("upsert_cases")
def upsert_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert a new snapshot of records, keeping first_seen_at."""
    old, new = _snapshots(spark, sf_dir)
    return store.upsert(old, new, "case_id", keep_first=["first_seen_at"])


@query("bucket_upsert")
def bucket_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 in a table filed by key: a new snapshot merged into the buckets of its keys; newest
    content, first time seen."""
    old, new = _snapshots(spark, sf_dir)

    def merge(rows: DataFrame) -> DataFrame:
        content = F.max_by(F.struct("title", "capability"), "last_updated_at")
        return rows.groupBy("case_id").agg(
            content.alias("v"), F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_updated_at").alias("last_updated_at")).select(
            "case_id", "v.title", "v.capability", "first_seen_at", "last_updated_at")
    table = BucketTable(spark, scratch_path(spark, "buckets"), "case_id", old.schema, merge, n=16)
    table.upsert(old, "old")
    table.upsert(new, "new")
    return table.read()


@query("insert_if_absent")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open runs that do not exist yet; existing run rows are left alone."""
    old, new = _run_snapshots(spark, sf_dir)
    return store.insert_if_absent(old, new, "run_id")


@query("replace_run")
def replace_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: new run rows replace the stored rows with the same run id."""
    old, new = _run_snapshots(spark, sf_dir)
    return store.replace_by_key(old, new, "run_id")


@query("orphans")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores checked against the stored records and runs as of the older snapshots
    (records of three segments, runs opened up to day 20): scores of the other records
    and of later runs reference rows that are not stored."""
    t = fx.tables(spark, sf_dir)
    old_records, _ = _snapshots(spark, sf_dir)
    old_runs, _ = _run_snapshots(spark, sf_dir)
    return store.orphans(fx.scores(t), old_records, old_runs).select(
        "score_id", "case_id", "run_id", "reason")


@query("resume_remaining")
def resume_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents not scored yet (no label row) -- what a resumed run still has to do."""
    t = fx.tables(spark, sf_dir)
    return store.remaining(t.documents.select("doc_id", "lang", "source"),
                           t.labels.select("doc_id"), key="doc_id")


# ------------------------------------------------------------------ dictionaries -------

from casegauge.session import scratch_path  # noqa: E402
from casegauge.sources import codemaps, files  # noqa: E402
from casegauge.sources.buckets import BucketTable  # noqa: E402


def _nation_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations written as a dictionary JSON (with a comment entry) and loaded from it."""
    names = fx.tables(spark, sf_dir).nation.agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("n_nationkey").cast("string"), "n_name"))).alias("m"))
    entries = F.map_concat("m", F.create_map(F.lit("_comment"), F.lit("not an id")))
    text_ = F.to_json(F.struct(F.struct(entries.alias("NATION_MAP")).alias("field_maps")))
    path = scratch_path(spark, "dictionary")
    names.select(text_.alias("value")).coalesce(1).write.text(path)
    return codemaps.load_dimension(spark, path)


@query("dictionary_decode")
def dictionary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every customer decoded through a loaded dictionary."""
    customers = fx.tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey")
    return codemaps.decode_with_dimension(customers, "c_nationkey",
                                          _nation_dictionary(spark, sf_dir), "NATION_MAP", "nation")


@query("rules_from_dictionary")
def rules_from_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six rules over a dictionary file, not over the fixed maps: the nations as
    record states, named by their region."""
    t = fx.tables(spark, sf_dir)
    state = F.element_at(F.array(*[F.lit(s) for s in (
        "New", "Reviewed", "Active", "Obsolete", "Inactive")]), F.col("n_regionkey") + 1)
    states = t.nation.agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("n_nationkey").cast("string"), state))).alias("STATUS_MAP"))
    path = scratch_path(spark, "dictionary")
    states.select(F.to_json(F.struct(F.struct("STATUS_MAP").alias("field_maps"))).alias("value")) \
        .coalesce(1).write.text(path)
    maps = codemaps.standards_maps(codemaps.load_dimension(spark, path))
    c = lambda value, name: F.lit(value).alias(name)
    raw = t.customer.select(
        "c_custkey", F.col("c_nationkey").cast("int").alias("case_status_id"),
        c(2, "custom_automatability"), c(17, "custom_testing_type"),
        c(1, "custom_automation_status"), c(1, "priority_id"),
        F.array(F.lit(12)).alias("custom_testing_phase"))
    return standards.evaluate(raw, standards.rules_for(maps)).select("c_custkey", "verdict", "remarks")


@query("screen_full")
def screen_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 17 report columns, from records that hold whole pages; tribe, product
    and capability are decoded through a loaded dictionary file."""
    t = fx.tables(spark, sf_dir)

    def labels(table: DataFrame, key: str, label: str, name: str) -> DataFrame:
        return table.select(F.lit(name).alias("name"),
                            F.struct(F.col(key).cast("string"), F.col(label)).alias("entry"))
    entries = labels(t.nation, "n_nationkey", "n_name", "TRIBE_MAP") \
        .union(labels(t.nation.withColumn("label", F.lower("n_name")), "n_nationkey", "label",
                      "PRODUCT_MAP")) \
        .union(labels(t.region, "r_regionkey", "r_name", "CAPABILITY_MAP"))
    maps = entries.groupBy("name").agg(F.map_from_entries(F.collect_list("entry")).alias("m"))
    document = maps.agg(F.map_from_entries(F.collect_list(F.struct("name", "m")))
                        .alias("retrieval_fields"))
    path = scratch_path(spark, "dictionary")
    document.select(F.to_json(F.struct("retrieval_fields")).alias("value")) \
        .coalesce(1).write.text(path)
    records = codemaps.decode_retrieval_fields(fx.page_records(t),
                                               codemaps.load_dimension(spark, path))
    return standards.flatten(records, *[F.col(f"__label_{label}")
                                        for _, _, label in codemaps.RETRIEVAL_FIELDS]) \
        .select(*standards.REPORT_COLUMNS)


@query("reverse_lookup")
def reverse_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """an id by its label, whatever the label's case, and the customers that carry it."""
    hit = codemaps.find_by_label(_nation_dictionary(spark, sf_dir), "NATION_MAP", "Nation_7")
    customers = fx.tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey")
    return customers.join(hit, customers["c_nationkey"] == hit["id"]).select("c_custkey", "id")


# ------------------------------------------------------------------ text & scoring -----

from casegauge.functions import html, text  # noqa: E402
from casegauge.operators import score  # noqa: E402


@query("html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """visible text of every page."""
    p = fx.html_pages(fx.tables(spark, sf_dir))
    return p.select("page_id", html.html_to_text(F.col("html")).alias("text"))


@query("numbered_list")
def numbered_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: every list item of every page as numbered lines."""
    p = fx.html_pages(fx.tables(spark, sf_dir))
    return p.select("page_id", html.numbered_list(F.col("html")).alias("items"))


@query("endpoint_from_link")
def endpoint_from_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id from each link, its endpoint, and the rows rejected for no id."""
    pages = fx.tables(spark, sf_dir).pages.select("page_id", "url")
    rid = text.extract_id(F.col("url"), "/([0-9]+)")
    return pages.select("page_id", rid.alias("record_id"),
                        text.endpoint(rid).alias("endpoint"),
                        F.when(rid.isNull(), "rejected").otherwise("ok").alias("status"))


@query("link_builder")
def link_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link from an id column (digits kept, '' when none)."""
    c = fx.tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    return c.select("c_custkey", F.col("c_name").alias("ID"),
                    text.build_link(F.col("c_name")).alias("link"))


@query("steps_join")
def steps_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every conversation's turns as a record's steps (content = text, expected =
    role), each part joined by newline in turn order; skew-safe two-level gather."""
    c = fx.tables(spark, sf_dir).conversations.select("conv_id", "turn", "role", "text")
    return standards.steps_text_by_key(c, "conv_id", "turn",
                                       {"steps": "text", "expected": "role"})


@query("json_result_parse")
def json_result_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON out of free-text replies, typed and validated."""
    r = fx.replies(fx.tables(spark, sf_dir))
    p = text.parse_replies(r, "reply", "request_id", out="r")
    ok = F.col("r.valid")
    return p.select("event_id", ok.alias("is_valid"),
                    F.when(ok, F.col("r.test_case_id")).alias("test_case_id"),
                    F.when(ok, F.col("r.verdict")).alias("verdict"),
                    F.when(ok, F.col("r.preconditions.passed")).alias("preconditions_passed"),
                    F.when(ok, F.col("r.test_steps.passed")).alias("test_steps_passed"),
                    F.when(ok, F.col("r.expected_results.passed")).alias("expected_results_passed"),
                    F.when(ok, F.col("r.overall_remarks")).alias("overall_remarks"))


@query("legacy_upgrade")
def legacy_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old-format report upgraded to the current columns."""
    legacy = fx.legacy_report(fx.tables(spark, sf_dir))
    up = files.normalize_validation(legacy)
    return up.select(F.col("Test Case ID").alias("test_case_id"), F.col("Verdict").alias("verdict"),
                     F.col("Overall Remarks").alias("overall_remarks"),
                     F.col("Improvements").alias("improvements"),
                     text.flag_to_int(F.col("Overall Passed")).alias("overall_passed_int"))


@query("rule_screen")
def rule_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic standards screen over every document, as report rows."""
    cases = fx.documents_as_cases(fx.tables(spark, sf_dir))
    return score.result_rows(score.rule_screen(cases))


@query("rule_screen_numbered")
def rule_screen_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 on steps as the screen's own report writes them ("1. Click ..."): the verdicts are
    those of the plain lines."""
    cases = fx.documents_as_cases(fx.tables(spark, sf_dir))
    numbered = F.array_join(F.transform(
        F.split("test_steps", "\n"),
        lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s)), "\n")
    return score.result_rows(score.rule_screen(cases.withColumn("test_steps", numbered)))


@query("rule_screen_titled")
def rule_screen_titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 with the title rule: titles must hold the platform's label (here a language)."""
    cases = fx.documents_as_cases(fx.tables(spark, sf_dir))
    return score.result_rows(score.rule_screen(cases, title="title", platform="EN"))


@query("prompt_with_standards")
def prompt_with_standards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluator's prompt for every document, with a standards document read from
    a text file (the regions' names, a line each)."""
    t = fx.tables(spark, sf_dir)
    path = scratch_path(spark, "standards")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("r_regionkey", "r_name"))),
                        lambda r: r["r_name"])
    t.region.agg(F.array_join(lines, "\n").alias("value")).coalesce(1).write.text(path)
    # one document of configuration, a literal of the plan
    written = files.read_standards(spark, path).first()["standards"]
    c = F.col
    return fx.documents_as_cases(t).select("case_id", score.evaluation_prompt(
        F.lit(written), F.lit(""), c("case_id"), c("title"), F.substring_index("title", "/", 1),
        F.lit(None), c("pre_conditions"), c("test_steps"), c("expected_result"),
        "Answer as JSON.").alias("prompt"))


@query("score_resume")
def score_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stopped with every other document scored and stored, and
    was resumed over all documents: the whole run's report, each document once."""
    base = scratch_path(spark, "resumed-store")
    d = fx.documents_as_cases(fx.tables(spark, sf_dir))
    passed = d.select(
        F.col("case_id").cast("string").alias("Test Case ID"), F.col("title").alias("Title"),
        F.col("pre_conditions").alias("Pre Conditions"), F.col("test_steps").alias("Test Steps"),
        F.col("expected_result").alias("Expected Result"))
    before = passed.where(F.col("Test Case ID").cast("long") % 2 == 0)
    for part in (before, passed):
        api.validate_cases(spark, part, base, run_id="20240601_090000")
    return api.run_report(spark, base, "20240601_090000")


@query("run_stamps")
def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the one UTC timestamp of a call, as all that it stores carries it: scores, records
    seen, and the run."""
    base = scratch_path(spark, "stamped-store")
    d = fx.documents_as_cases(fx.tables(spark, sf_dir))
    passed = d.select(F.col("case_id").cast("string").alias("Test Case ID"),
                      F.col("title").alias("Title"), F.lit("1. Open https://x").alias("Pre Conditions"),
                      F.lit(None).cast("string").alias("Test Steps"),
                      F.lit("Shown").alias("Expected Result"))
    api.validate_cases(spark, passed, base, run_id="r1")
    at = api.read_runs(spark, base).select(F.col("run_at").alias("at"), "run_id")
    utc = F.col("at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?\+00:00$")
    seen = api.read_facts(spark, base).select("case_id", "run_id", "validated_at").join(
        api.read_records(spark, base), "case_id").join(at, "run_id")
    return seen.select("case_id", utc.alias("utc"), (F.col("validated_at") == F.col("at")).alias("scored"),
                       (F.col("first_seen_at") == F.col("at")).alias("first"),
                       (F.col("last_updated_at") == F.col("at")).alias("last"))


@query("score_batch")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pluggable Python evaluator over Arrow batches; replies parsed natively."""
    cases = fx.documents_as_cases(fx.tables(spark, sf_dir))
    scored = score.score(cases.select(F.col("case_id").cast("string").alias("case_id"), "title",
                                      "pre_conditions", "test_steps", "expected_result"),
                         score.completeness_evaluator)
    return score.result_rows(scored, title_col=None)


# ------------------------------------------------------------------ similar examples ---

from casegauge.operators import similar  # noqa: E402

SIMILAR = dict(target=5, min_per_level=3, seed="seed")


def _scored_records(t, details: bool = False) -> DataFrame:
    """J7 + P21: records whose latest score (one per record) has a verdict; with
    ``details`` also the record texts and the latest score's flags and remarks (what a
    few-shot example shows)."""
    if not details:
        latest = store.latest_per_key(fx.scores(t), dedup=True, tie_break=["score_id"])
        return (fx.cases(t).join(latest.where(F.col("verdict").isNotNull())
                                 .select("case_id", "verdict"), "case_id", "inner"))
    latest = store.latest_per_key(fx.scores(t, remarks=True), dedup=True, tie_break=["score_id"])
    recs = fx.cases(t, texts=True)
    from_score = [c for c in similar.EXAMPLE_DETAILS if c not in recs.columns]
    return recs.join(latest.where(F.col("verdict").isNotNull())
                     .select("case_id", "verdict", *from_score), "case_id", "inner")


@query("similar_examples")
def similar_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 5 similar scored examples for every record."""
    t = fx.tables(spark, sf_dir)
    return similar.similar_examples(fx.cases(t), _scored_records(t), **SIMILAR)


# ------------------------------------------------------------------ streaming ----------

from casegauge.session import scratch_path  # noqa: E402
from casegauge.streaming import incremental as inc  # noqa: E402


def _land_scores(spark: SparkSession, sf_dir: str, src: str, part: str) -> None:
    s = fx.scores(fx.tables(spark, sf_dir))
    day = F.dayofmonth("validated_at")
    first = F.coalesce(day <= 15, F.lit(False))
    inc.land_files(s.where(first if part == "first" else ~first), src)
    if part == "second":  # the first half's files arrive again, beside the new ones
        inc.land_files(s.where(first), src)


def _land_results(spark: SparkSession, sf_dir: str, src: str, part: str) -> None:
    r = fx.scored_results(fx.tables(spark, sf_dir))
    day = F.dayofmonth("validated_at")
    first = F.coalesce(day <= 15, F.lit(False))
    inc.land_files(r.where(first if part == "first" else ~first), src)


@query("stream_records")
def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored records saved incrementally (scores appended, record snapshots
    logged per micro-batch, resumed from the checkpoint); the record table read back is
    the upsert of every snapshot: newest content, first and last time seen."""
    base = scratch_path(spark, "stream-records")
    src, store_dir, ckpt = f"{base}/in", f"{base}/store", f"{base}/ckpt"
    for part in ("first", "second"):
        _land_results(spark, sf_dir, src, part)
        inc.run_to_completion(inc.save_results_stream(spark, src, store_dir, ckpt))
    return inc.current_records(spark.read.parquet(f"{store_dir}/record_log"))


@query("stream_counters")
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run counters maintained by a streaming aggregate over landed score files
    (two arrivals, each its own micro-batch, the second with copies of the first's files); must
    equal the batch aggregate."""
    base = scratch_path(spark, "stream-counters")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    for part in ("first", "second"):
        _land_scores(spark, sf_dir, src, part)
        inc.run_to_completion(inc.run_counters_stream(spark, src, sink, ckpt))
    return inc.read_merged(spark, sink, "run_id")


@query("stream_upsert")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores persisted incrementally; the second run resumes from the checkpoint
    and only processes the new files, among them copies of those stored before -- every score
    stored exactly once."""
    base = scratch_path(spark, "stream-upsert")
    src, sink, ckpt = f"{base}/in", f"{base}/facts", f"{base}/ckpt"
    for part in ("first", "second"):
        _land_scores(spark, sf_dir, src, part)
        inc.run_to_completion(inc.save_scores_stream(spark, src, sink, ckpt))
    return spark.read.parquet(sink).drop("batch_id")


def _save_replies(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    """Reply lines landed in two arrivals, the second with copies of the first, and saved
    against the records and runs of the older snapshots."""
    base = scratch_path(spark, "stream-replies")
    src, store_dir, ckpt = f"{base}/in", f"{base}/store", f"{base}/ckpt"
    t = fx.tables(spark, sf_dir)
    records, _ = _snapshots(spark, sf_dir)
    runs, _ = _run_snapshots(spark, sf_dir)
    lines = fx.reply_lines(t)
    first = lines.where("score_id % 2 = 0").select("value")
    for part in (first, lines.select("value")):
        part.write.mode("append").text(src)
        inc.run_to_completion(inc.save_replies_stream(spark, src, store_dir, ckpt, records, runs))
    return store_dir, records, runs


@query("stream_quarantine")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed reply line once -- stored, or in the quarantine with its reason
    (a torn line with its text)."""
    store_dir, _, _ = _save_replies(spark, sf_dir)
    facts = spark.read.parquet(f"{store_dir}/facts")
    lost = spark.read.parquet(f"{store_dir}/quarantine")
    torn = F.col("reason") == "unreadable line"
    return facts.select(*inc.SCORE_KEY, "verdict", F.lit("stored").alias("outcome"),
                        F.lit(None).cast("string").alias("line")).unionByName(
        lost.select(*inc.SCORE_KEY, F.lit(None).cast("string").alias("verdict"),
                    F.col("reason").alias("outcome"), F.when(torn, F.col("raw")).alias("line")))


@query("stream_readmit")
def stream_readmit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined replies stored once their records and runs are known; the runs'
    counters, summed over the parts' own counts."""
    store_dir, records, runs = _save_replies(spark, sf_dir)
    t = fx.tables(spark, sf_dir)
    everyone = t.customer.select(F.col("c_custkey").alias("case_id"))
    inc.readmit(spark, store_dir, everyone, runs, 0)
    inc.readmit(spark, store_dir, everyone, fx.runs(t), 1)
    return inc.read_counters(spark, store_dir)


# ------------------------------------------------------------------ ingest & export ----

def _land_responses(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "landed-responses")
    fx.landed_response_lines(fx.tables(spark, sf_dir)).write.text(path)
    return path


@query("ingest_screen")
def ingest_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed fetch results -> status-200 records -> screened report rows."""
    env, _bad = files.read_responses(spark, _land_responses(spark, sf_dir))
    rep = standards.flatten(files.fetched_records(env))
    return rep.select("General Standards", "Remarks", "Test Case ID", "Priority",
                      "Automatability", "Automation Status", "Testing Type", "Status",
                      "Testing Phase")


@query("ingest_quarantine")
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a screening run can't use, stored and read back: unreadable response lines with
    their text, and links without an id."""
    base = scratch_path(spark, "quarantine")
    _, torn = files.read_responses(spark, _land_responses(spark, sf_dir))
    ids = fx.tables(spark, sf_dir).customer.select(
        F.col("c_custkey").cast("string").alias("ID"),
        F.when(F.col("c_acctbal") < 0, F.lit("https://cases.example.com/"))
        .otherwise(text.build_link(F.col("c_name"))).alias("Testrail Link"))
    _, rejected = files.endpoints_from_source(ids)
    return files.read_quarantine(spark, files.write_quarantine(torn, rejected, base, "20240601_090000"))


@query("ingest_counts")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11 + quarantine: fetched ok / failed envelopes and torn lines, in one pass."""
    return files.ingest_counts(spark, _land_responses(spark, sf_dir))


@query("fetch_coverage")
def fetch_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every endpoint of the id list with what its fetch gave -- ok, failed
    (non-200 / no status) or not fetched (its landed line was torn)."""
    t = fx.tables(spark, sf_dir)
    env, _bad = files.read_responses(spark, _land_responses(spark, sf_dir))
    ids = t.orders.select(F.col("o_orderkey").cast("string").alias("ID"))
    endpoints = ids.select("ID", text.endpoint(F.col("ID")).alias("endpoint"))
    return files.fetch_status(endpoints, env)


@query("endpoint_file")
def endpoint_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An id list read from CSV, the endpoint file written from it and read
    back, and the ids whose link holds no record id."""
    base = scratch_path(spark, "id-list")
    ids = fx.tables(spark, sf_dir).customer.select(
        F.col("c_custkey").cast("string").alias("ID"),
        F.when(F.col("c_acctbal") < 0, F.lit("https://cases.example.com/"))
        .otherwise(text.build_link(F.col("c_name"))).alias("Testrail Link"))
    files.csv_writer(ids.write).csv(f"{base}/customers.csv")
    path, rejected = api.generate_endpoint_file(spark, f"{base}/customers.csv", base)
    return files.read_csv(spark, path, required=("ID", "endpoint")).withColumn(
        "link", F.lit(None).cast("string")).unionByName(
        rejected.withColumn("endpoint", F.lit(None).cast("string")))


@query("filtered_export")
def filtered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records whose latest verdict is Failed, exported as CSV and read back."""
    base = scratch_path(spark, "export")
    rows = report.apply_filters(_latest_view(spark, sf_dir), report.verdict_filter("Failed"))
    path = files.write_snapshot(
        rows.select("case_id", "title", "capability", "verdict", "run_id"), base,
        "20240601_090000", fmt="csv")
    return files.read_csv(spark, path)


@query("csv_snapshot_roundtrip")
def csv_snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line text exported as CSV snapshots; the newest snapshot is
    found from file names alone and read back under its column contract."""
    base = scratch_path(spark, "csv-snapshots")
    pages = fx.html_pages(fx.tables(spark, sf_dir))
    older = pages.select("page_id", html.numbered_list(F.col("html")).alias("text"))
    newer = pages.select("page_id", html.html_to_text(F.col("html")).alias("text"))
    files.write_snapshot(older, base, "20240101_090000", fmt="csv")
    files.write_snapshot(newer, base, "20240102_090000", fmt="csv")
    return files.read_latest_report(spark, base, fmt="csv", required=["page_id", "text"])


@query("few_shot_context")
def few_shot_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the calibration text built from each record's similar examples."""
    t = fx.tables(spark, sf_dir)
    ex = similar.similar_examples(fx.cases(t), _scored_records(t, details=True),
                                  carry=similar.EXAMPLE_DETAILS, **SIMILAR)
    return similar.few_shot_context(ex)
