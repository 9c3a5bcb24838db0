"""Relations derived from the driver tables so every operator runs on data that grows
with them (FIXTURES.md section 3). Each derivation is a plain projection/join and has a
line-for-line SQL twin in ``casegauge.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegauge.sources.tables import Tables

PROVIDER = "rule-screen"
MODEL = "standards-v1"


def cases_raw(t: Tables) -> DataFrame:
    """Raw nested records (D4 shape) from ``orders``: codes spread over pass/fail values."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    arr = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<int>")
    phase = (F.when(k % 8 == 0, arr()).when(k % 8 == 1, F.lit(None).cast("array<int>"))
             .when(k % 8 == 2, arr(3, 4)).when(k % 8 == 3, arr(99)).when(k % 8 == 4, arr(12))
             .when(k % 8 == 5, arr(2, 5)).otherwise(arr(1, 3)))
    null = F.lit(None).cast("string")
    return o.select(
        k.alias("id"),
        null.alias("title"),
        null.alias("custom_project_initiative"),
        F.lit(None).cast("int").alias("custom_case_tribe"),
        F.lit(None).cast("int").alias("custom_product_prod"),
        F.lit(None).cast("int").alias("custom_capability"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .otherwise(F.substring("o_orderpriority", 1, 1).cast("int")).alias("priority_id"),
        F.when(k % 4 == 0, k % 7).otherwise(2).cast("int").alias("custom_automatability"),
        F.when(k % 6 == 0, c % 12).otherwise(1).cast("int").alias("custom_automation_status"),
        F.when(k % 5 == 0, k % 23).otherwise(17).cast("int").alias("custom_testing_type"),
        F.when(F.col("o_orderstatus") == "F", 6).when(F.col("o_orderstatus") == "O", 2)
        .otherwise(1 + c % 6).cast("int").alias("case_status_id"),
        phase.alias("custom_testing_phase"),
        null.alias("custom_preconds"),
        F.lit(None).cast("array<struct<content:string,expected:string>>")
        .alias("custom_steps_separated"),
    )


def page_records(t: Tables) -> DataFrame:
    """Raw nested records (D4 shape) from ``pages``: the whole html as initiative, preconditions
    and steps, and codes spread by the page's id."""
    k = F.col("page_id")
    arr = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<int>")
    step = lambda a, b: F.struct(a.cast("string").alias("content"),
                                 b.cast("string").alias("expected"))
    return t.pages.select(
        k.alias("id"), F.col("url").alias("title"),
        F.col("html").alias("custom_project_initiative"),
        (k % 30).cast("int").alias("custom_case_tribe"),
        (k % 26).cast("int").alias("custom_product_prod"),
        F.when(k % 3 != 0, (k % 5).cast("int")).alias("custom_capability"),
        F.when(k % 9 != 0, (1 + k % 4).cast("int")).alias("priority_id"),
        F.when(k % 4 == 0, k % 7).otherwise(2).cast("int").alias("custom_automatability"),
        F.when(k % 6 == 0, k % 12).otherwise(1).cast("int").alias("custom_automation_status"),
        F.when(k % 5 == 0, k % 23).otherwise(17).cast("int").alias("custom_testing_type"),
        F.when(k % 7 == 0, 1 + k % 6).otherwise(2).cast("int").alias("case_status_id"),
        F.when(k % 8 == 0, arr()).when(k % 8 == 1, F.lit(None)).when(k % 8 == 2, arr(3, 4))
        .when(k % 8 == 3, arr(99)).otherwise(arr(1, 12)).alias("custom_testing_phase"),
        F.col("html").alias("custom_preconds"),
        F.array(step(F.col("html"), F.col("html")), step(F.lit(None), F.lit("Shown")))
        .alias("custom_steps_separated"))


def cases(t: Tables, texts: bool = False) -> DataFrame:
    """Store records (D7 subset): customer joined to its nation and region; with
    ``texts`` also the three record texts (some empty or NULL), from the same scan.

    No broadcast hint: ``nation`` and ``region`` are broadcast by the planner because their
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (and by AQE on runtime
    sizes); a dimension that outgrew it would get a sort-merge join instead of an
    unchecked broadcast.
    """
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
         .join(r, n.n_regionkey == r.r_regionkey, "inner"))
    extra = []
    if texts:
        extra = [
            F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("Account in segment "), "c_mktsegment"))
            .alias("pre_conditions"),
            F.when(F.col("c_acctbal") < 1000, F.lit("")).otherwise(F.concat(
                F.lit("1. Open the account page\n2. Select nation "),
                F.col("c_nationkey").cast("string"))).alias("test_steps"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit(""))
            .otherwise(F.concat(F.lit("Segment "), "c_mktsegment", F.lit(" is shown")))
            .alias("expected_result")]
    return j.select(
        F.col("c_custkey").alias("case_id"),
        F.col("c_name").alias("title"),
        F.col("r_name").alias("tribe"),
        F.col("n_name").alias("product"),
        F.concat_ws("/", "n_name", "c_mktsegment").alias("capability"),
        *extra,
    )


def scores(t: Tables, remarks: bool = False) -> DataFrame:
    """Score facts (D9) from ``events``: one scoring attempt per event, run = event day;
    with ``remarks`` also per-criterion remarks, overall remarks and improvements."""
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    verdict = (F.when(F.col("event_type") == "purchase", "Passed")
               .when(F.col("event_type").isin("view", "click"), "Needs Improvement")
               .when(F.col("event_type") == "signup", "Failed"))
    scored = F.col("event_type") != "error"
    flag = lambda cond: F.when(scored, cond)

    def remark(limit: int, what: str) -> Column:
        return (F.when(~scored, F.lit(None)).when(F.col("value") >= limit, F.lit(""))
                .otherwise(F.lit(f"{what} below {limit}")))
    extra = []
    if remarks:
        extra = [
            remark(5, "precondition value").alias("preconditions_remarks"),
            remark(10, "steps value").alias("test_steps_remarks"),
            remark(2, "expected value").alias("expected_results_remarks"),
            F.when(F.col("event_type") == "purchase", F.lit(""))
            .otherwise(F.concat(F.lit("event "), "event_type")).alias("overall_remarks"),
            F.when(F.col("event_type") == "signup", F.lit("add the missing steps"))
            .alias("improvements")]
    return e.select(
        F.col("event_id").alias("score_id"),
        F.col("user_id").alias("case_id"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("run_id"),
        verdict.alias("verdict"),
        flag(F.col("value") >= 5).alias("preconditions_passed"),
        flag(F.col("value") >= 10).alias("test_steps_passed"),
        flag(F.col("value") >= 2).alias("expected_results_passed"),
        F.col("ts").alias("validated_at"),
        *extra,
    )


def scored_results(t: Tables) -> DataFrame:
    """One result row per scoring attempt: the score plus the record content as it was
    sent (the title names the run; an errored attempt carries no tribe)."""
    c = cases(t).select("case_id", "title", "tribe", "product", "capability")
    s = scores(t)
    j = s.join(c.withColumnRenamed("title", "case_title").withColumnRenamed("tribe", "case_tribe"),
               "case_id", "inner")
    return j.select(*s.columns,
                    F.concat("case_title", F.lit(" ["), "run_id", F.lit("]")).alias("title"),
                    F.when(F.col("verdict").isNotNull(), F.col("case_tribe")).alias("tribe"),
                    "product", "capability")


def runs(t: Tables) -> DataFrame:
    """Run rows (D8 without counters): one per day, opened at its first score."""
    return (scores(t).groupBy("run_id")
            .agg(F.min("validated_at").alias("run_at"), F.count(F.lit(1)).alias("total_cases"))
            .select("run_id", F.lit(PROVIDER).alias("provider"), F.lit(MODEL).alias("model"),
                    "total_cases", "run_at"))


def html_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "html")


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def documents_as_cases(t: Tables) -> DataFrame:
    """Documents read as test cases: first line = preconditions, last line = expected
    result, the lines between = steps (whole texts, every line)."""
    d = t.documents.select("doc_id", "text", "lang", "source")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    n = F.size(lines)
    return d.select(
        F.col("doc_id").alias("case_id"),
        F.concat_ws("/", "lang", "source").alias("title"),
        F.element_at(lines, 1).alias("pre_conditions"),
        F.when(n >= 3, F.array_join(F.slice(lines, 2, n - 2), "\n")).otherwise(F.lit(""))
        .alias("test_steps"),
        F.when(n >= 2, F.element_at(lines, -1)).otherwise(F.lit("")).alias("expected_result"),
    )


def replies(t: Tables) -> DataFrame:
    """Free-text evaluator replies built from ``events``: fenced, prose-wrapped, bare, or
    without any JSON; some miss the verdict key, some carry a verdict outside the enum."""
    e = t.events.select("event_id", "user_id", "event_type", "value", "props")
    b = lambda c: F.when(c, F.lit("true")).otherwise(F.lit("false"))
    verdict = (F.when(F.col("event_type") == "purchase", '"verdict": "Passed", ')
               .when(F.col("event_type").isin("view", "click"), '"verdict": "Needs Improvement", ')
               .when(F.col("event_type") == "signup", '"verdict": "Failed", ')
               .when(F.col("value") >= 20, '"verdict": "Maybe", ')
               .otherwise(""))
    body = F.concat(
        F.lit('{"test_case_id": "C'), F.col("user_id").cast("string"),
        F.lit('", "preconditions": {"passed": '), b(F.col("value") >= 5),
        F.lit(', "remarks": ""}, "test_steps": {"passed": '), b(F.col("value") >= 10),
        F.lit(', "remarks": "steps"}, "expected_results": {"passed": '), b(F.col("value") >= 2),
        F.lit(', "remarks": ""}, '), verdict,
        F.lit('"overall_remarks": "event '), F.col("event_type"),
        F.lit('", "improvements": "", "context": '), F.col("props"), F.lit("}"))
    k = F.col("event_id") % 4
    reply = (F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
             .when(k == 1, F.concat(F.lit("Here is my evaluation:\n```\n"), body,
                                    F.lit("\n```\nDone.")))
             .when(k == 2, F.concat(F.lit("Result: "), body, F.lit(" -- end")))
             .otherwise(F.lit("I could not evaluate this case.")))
    return e.select("event_id", F.concat(F.lit("C"), F.col("user_id").cast("string"))
                    .alias("request_id"), reply.alias("reply"))


def legacy_report(t: Tables) -> DataFrame:
    """An old-format validation report: ``Overall Passed`` / ``Summary`` instead of
    ``Verdict`` / ``Overall Remarks`` / ``Improvements``; unlabeled documents = NULL flag."""
    d = t.documents.select("doc_id", "source")
    lab = t.labels.select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("Test Case ID"),
        F.col("source").alias("Title"),
        (F.col("quality") == 1).alias("Overall Passed"),
        F.when(F.col("toxic") == 1, F.lit("flagged as toxic"))
        .when(F.col("toxic") == 0, F.lit("")).alias("Summary"),
    )


def landed_response_lines(t: Tables) -> DataFrame:
    """Fetch results as JSON lines (one envelope per record): most fetched with status
    200, some 404, some with no status (network failure) and some torn lines."""
    raw = cases_raw(t)
    k = F.col("id")
    status = (F.when(k % 10 == 9, F.lit(404)).when(k % 50 == 7, F.lit(None))
              .otherwise(F.lit(200)).cast("int"))
    line = F.to_json(F.struct(F.col("id").cast("string").alias("ID"), status.alias("status_code"),
                              F.when(status == 200, F.struct(*[F.col(c) for c in raw.columns]))
                              .alias("response")))
    return raw.select(F.when(k % 97 == 5, F.substring(line, 1, 25)).otherwise(line).alias("value"))


def reply_lines(t: Tables) -> DataFrame:
    """One landed JSON line per scoring attempt (``score_id`` beside it); some replies name
    another record, some lines are torn."""
    s = scores(t)
    k = F.col("score_id")
    text_of = lambda c: F.coalesce(F.concat(F.lit('"'), F.col(c), F.lit('"')), F.lit("null"))
    line = F.concat(
        F.lit('{"score_id":'), k.cast("string"),
        F.lit(',"case_id":'), F.coalesce(F.col("case_id").cast("string"), F.lit("null")),
        F.lit(',"reply_case_id":'), F.coalesce(
            (F.col("case_id") + F.when(k % 50 == 7, 1).otherwise(0)).cast("string"), F.lit("null")),
        F.lit(',"run_id":'), text_of("run_id"), F.lit(',"verdict":'), text_of("verdict"), F.lit("}"))
    return s.select("score_id", F.when(k % 97 == 5, F.substring(line, 1, 25)).otherwise(line)
                    .alias("value"))
