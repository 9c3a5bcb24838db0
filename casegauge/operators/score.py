"""Scoring passed records.

* ``rule_screen`` (X2) is the default evaluator: the written standards as native
  predicates over whole texts -- no Python, no network, whole-stage codegen.
* ``score`` (X1) runs any *pluggable* Python evaluator over Arrow batches with
  ``mapInPandas``: one call per batch, errors isolated per row and kept as rows.
  Its replies are parsed natively (``text.parse_replies``).
* ``result_rows`` (X3) projects either result to the 11-column report.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.functions import text

# --- Fixed values: vocabulary of the deterministic standards screen. ---
IMPERATIVE_VERBS = ("open", "click", "enter", "type", "select", "navigate", "go", "verify",
                    "check", "input", "fill", "submit", "press", "login", "log", "tap",
                    "choose", "upload", "download", "scroll", "wait", "launch", "close", "insert")
INPUT_VERBS = ("enter", "type", "input", "fill", "insert")
ORDINAL_RE = r"^[0-9]+\.\s*"
CREDENTIAL_WORDS = ("username", "password", "login", "credential", "account", "role", "user")
ENVIRONMENT_WORDS = ("sit", "uat", "staging", "prod", "production", "environment")
COMPOUND_WORDS = ("then", "and then")
PLATFORM = "Web"
TITLE_REMARK = "title lacks the platform label"
# --- end of fixed values ---


def _words(words) -> str:
    return "(^|[^a-z])(" + "|".join(words) + ")([^a-z]|$)"


URL_RE = "https?://"
CREDENTIAL_RE = _words(CREDENTIAL_WORDS)
ENVIRONMENT_RE = _words(ENVIRONMENT_WORDS)
IMPERATIVE_RE = "^(" + "|".join(IMPERATIVE_VERBS) + ")([^a-z]|$)"
INPUT_RE = "^(" + "|".join(INPUT_VERBS) + ")([^a-z]|$)"
COMPOUND_RE = _words(COMPOUND_WORDS)
DATA_RE = "[\"'0-9]"


def _step(line: Column) -> Column:
    return text.py_strip(F.regexp_replace(text.py_strip(line), ORDINAL_RE, ""))


def rule_screen(cases: DataFrame, pre: str = "pre_conditions", steps: str = "test_steps",
                expected: str = "expected_result", title: str | None = None,
                platform: str = PLATFORM) -> DataFrame:
    """Evaluate the three criteria with native predicates; adds an ``evaluation``
    struct shaped like the evaluator result (passed/remarks per criterion, verdict,
    overall remarks, improvements).

    Verdict: every criterion holds -> Passed; required content absent (no URL and no
    credentials, no steps, or no expected result) -> Failed; otherwise Needs Improvement.

    With ``title`` (a column's name) the title rule of the written standards counts too: the
    title must hold the ``platform`` label as a word, in any case; else the verdict is Needs
    Improvement at best, and the overall remarks begin with it. It has no criterion of its own
    in the result, and an evaluator judges the other three only, so it is off by default.
    """
    base = cases.columns
    # 1) normalise the three texts once per row
    s1 = cases.select(
        *base,
        F.lower(F.coalesce(F.col(pre), F.lit(""))).alias("__p"),
        # lower-casing never adds or removes a newline, so the whole text is lowered once
        # the screen's own steps are numbered lines ("1. Click ..."): the ordinal is no
        # part of the step, and its digit is no test data
        F.filter(F.transform(F.split(F.lower(F.coalesce(F.col(steps), F.lit(""))), "\n"),
                             _step), lambda s: s != "").alias("__low"),
        text.py_strip(F.coalesce(F.col(expected), F.lit(""))).alias("__e"),
        (F.lower(F.coalesce(F.col(title), F.lit(""))).rlike(_words([re.escape(platform.lower())]))
         if title else F.lit(True)).alias("__titled"))
    # 2) the predicates
    p, low = F.col("__p"), F.col("__low")
    first_step = F.coalesce(F.try_element_at(low, F.lit(1)), F.lit(""))
    s2 = s1.select(
        *base, "__titled",
        (p.rlike(URL_RE) | first_step.rlike(URL_RE)).alias("has_url"),
        p.rlike(CREDENTIAL_RE).alias("has_cred"),
        p.rlike(ENVIRONMENT_RE).alias("env_word"),
        (F.size(low) > 0).alias("has_steps"),
        F.forall(low, lambda s: s.rlike(IMPERATIVE_RE)).alias("imperative"),
        F.forall(low, lambda s: ~s.rlike(COMPOUND_RE)).alias("atomic"),
        F.forall(low, lambda s: ~s.rlike(INPUT_RE) | s.rlike(DATA_RE)).alias("with_data"),
        (F.col("__e") != "").alias("has_expected"))
    # 3) verdict and remarks from the flags
    c = F.col
    has_url, has_cred, has_steps = c("has_url"), c("has_cred"), c("has_steps")
    has_env = c("env_word") | has_url
    imperative, atomic, with_data, has_expected = (c("imperative"), c("atomic"), c("with_data"),
                                                   c("has_expected"))
    pre_ok = has_url & has_cred & has_env
    steps_ok = has_steps & imperative & atomic & with_data
    pre_rm = F.concat_ws("; ", F.when(~has_url, "URL missing"),
                         F.when(~has_cred, "credentials missing"),
                         F.when(~has_env, "environment missing"))
    steps_rm = F.concat_ws("; ", F.when(~has_steps, "no test steps"),
                           F.when(has_steps & ~imperative, "steps not imperative"),
                           F.when(has_steps & ~atomic, "steps not atomic"),
                           F.when(has_steps & ~with_data, "input steps lack data"))
    exp_rm = F.when(~has_expected, F.lit("expected result missing")).otherwise(F.lit(""))
    failed = (~has_url & ~has_cred) | ~has_steps | ~has_expected
    verdict = (F.when(pre_ok & steps_ok & has_expected & c("__titled"), "Passed")
               .when(failed, "Failed").otherwise("Needs Improvement"))
    s3 = s2.select(*base, pre_ok.alias("pre_ok"), steps_ok.alias("steps_ok"), "has_expected",
                   pre_rm.alias("pre_rm"), steps_rm.alias("steps_rm"), exp_rm.alias("exp_rm"),
                   verdict.alias("verdict"),
                   F.when(~c("__titled"), F.lit(TITLE_REMARK)).alias("title_rm"))
    overall = F.concat_ws("; ", c("title_rm"), F.nullif(c("pre_rm"), F.lit("")), F.nullif(c("steps_rm"), F.lit("")),
                          F.nullif(c("exp_rm"), F.lit("")))
    crit = lambda ok, rm: F.struct(c(ok).alias("passed"), c(rm).alias("remarks"))
    return s3.select(*base, F.struct(
        crit("pre_ok", "pre_rm").alias("preconditions"),
        crit("steps_ok", "steps_rm").alias("test_steps"),
        crit("has_expected", "exp_rm").alias("expected_results"),
        c("verdict").alias("verdict"),
        overall.alias("overall_remarks"),
        F.when(c("verdict") == "Passed", F.lit("")).otherwise(
            F.concat(F.lit("Address: "), overall)).alias("improvements")).alias("evaluation"))


# ------------------------------------------------------------------ evaluator prompt -----

# --- Fixed values: the layout of the per-record evaluation prompt. ---
PROMPT_STANDARDS_HEADING = "## Quality Standards Reference"
PROMPT_CASE_HEADING = "## Test Case to Evaluate"
PROMPT_SEPARATOR = "---"
PROMPT_EMPTY = "(empty)"
PROMPT_ID = "**Test Case ID:** "
PROMPT_TITLE = "**Title:** "
PROMPT_TYPE = "**Testing Type:** "
PROMPT_PHASE = "**Testing Phase:** "
PROMPT_PRE = "**Pre Conditions:**"
PROMPT_STEPS = "**Test Steps:**"
PROMPT_EXPECTED = "**Expected Result:**"
CRITERION_ERROR = "Validation error: "
OVERALL_ERROR = "Error during validation: "
# --- end of fixed values ---


def evaluation_prompt(standards: Column, context: Column, case_id: Column, title: Column,
                      testing_type: Column, testing_phase: Column, pre: Column, steps: Column,
                      expected: Column, instructions: str) -> Column:
    """F22 (N6): the prompt for one record -- the standards document, the reference
    examples section (``context``; empty when there are none), the record's fields and
    texts (missing texts print ``(empty)``, missing metadata prints nothing), then the
    caller's ``instructions``. One native string expression per row."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    text_or_empty = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")),
                                         F.lit(PROMPT_EMPTY))
    return F.concat_ws(
        "\n",
        F.lit(PROMPT_STANDARDS_HEADING), F.lit(""), blank(standards), F.lit(""),
        F.lit(PROMPT_SEPARATOR), blank(context), F.lit(PROMPT_CASE_HEADING), F.lit(""),
        F.concat(F.lit(PROMPT_ID), blank(case_id)),
        F.concat(F.lit(PROMPT_TITLE), blank(title)),
        F.concat(F.lit(PROMPT_TYPE), blank(testing_type)),
        F.concat(F.lit(PROMPT_PHASE), blank(testing_phase)),
        F.lit(""), F.lit(PROMPT_PRE), text_or_empty(pre),
        F.lit(""), F.lit(PROMPT_STEPS), text_or_empty(steps),
        F.lit(""), F.lit(PROMPT_EXPECTED), text_or_empty(expected),
        F.lit(""), F.lit(PROMPT_SEPARATOR), F.lit(""), F.lit(instructions))


# ------------------------------------------------------------------ pluggable path -------

Evaluator = Callable[[pd.DataFrame], pd.Series]

REPLY_SCHEMA = T.StructType([
    T.StructField("case_id", T.StringType()),
    T.StructField("reply", T.StringType()),
    T.StructField("call_error", T.StringType()),
])


class _OneByOne(Exception):
    """The evaluator is called once per row."""


def _run_evaluator(evaluator: Evaluator, id_col: str, per_row: bool = False, carry=()):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf[id_col].astype(str)
            try:
                if per_row:
                    raise _OneByOne
                replies = pd.Series(evaluator(pdf), index=pdf.index).astype(object)
                errors = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
            except Exception:
                # one row at a time: as asked for, or to isolate the rows that fail (a batch
                # that raised has answered none of its rows)
                replies, errors = [], []
                for i in range(len(pdf)):
                    try:
                        replies.append(evaluator(pdf.iloc[i:i + 1]).iloc[0])
                        errors.append(None)
                    except Exception as exc:  # the error becomes the row's result
                        replies.append(None)
                        errors.append(f"{type(exc).__name__}: {exc}")
                replies = pd.Series(replies, index=pdf.index, dtype=object)
                errors = pd.Series(errors, index=pdf.index, dtype=object)
            yield pd.DataFrame({"case_id": ids, "reply": replies, "call_error": errors,
                                **{c: pdf[c] for c in carry}})
    return run


def score(cases: DataFrame, evaluator: Evaluator, id_col: str = "case_id",
          columns: list[str] | None = None, parallelism: int | None = None,
          per_row: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Run ``evaluator`` (pandas DataFrame of cases -> Series of reply texts) over
    Arrow batches, then parse and validate replies natively.

    ``parallelism`` re-spreads the cases over that many tasks (the evaluator's
    concurrency, e.g. an external service's rate limit); by default the input
    partitioning is kept. With ``per_row`` the evaluator gets frames of one row, so every
    record is called exactly once, also beside records that fail (a paid service); without,
    a batch in which a row raises is called again row by row. ``carry`` columns stand in the
    result beside their row's evaluation, so that repeated ids need no join back. Failures never abort the job: a raising call or an invalid
    reply gives a row with NULL verdict/flags and the message in the remarks.
    """
    cols = [id_col] + [c for c in (columns or cases.columns) if c != id_col]
    src = cases.select(*cols)
    if parallelism:
        src = src.repartition(parallelism)
    replies = src.mapInPandas(_run_evaluator(evaluator, id_col, per_row, carry), T.StructType(
        [*REPLY_SCHEMA.fields, *[src.schema[c] for c in carry]]))
    parsed = text.parse_replies(replies, "reply", "case_id", out="r")
    err = F.coalesce(F.col("call_error"), F.col("r.error"))
    ok = F.col("call_error").isNull() & F.col("r.valid")
    pick = lambda c: F.when(ok, c)
    return parsed.select(
        "case_id",
        F.struct(
            F.struct(pick(F.col("r.preconditions.passed")).alias("passed"),
                     F.when(ok, F.col("r.preconditions.remarks"))
                     .otherwise(F.concat(F.lit(CRITERION_ERROR), err)).alias("remarks"))
            .alias("preconditions"),
            F.struct(pick(F.col("r.test_steps.passed")).alias("passed"),
                     F.when(ok, F.col("r.test_steps.remarks")).otherwise(F.lit("")).alias("remarks"))
            .alias("test_steps"),
            F.struct(pick(F.col("r.expected_results.passed")).alias("passed"),
                     F.when(ok, F.col("r.expected_results.remarks")).otherwise(F.lit(""))
                     .alias("remarks")).alias("expected_results"),
            pick(F.col("r.verdict")).alias("verdict"),
            F.when(ok, F.col("r.overall_remarks"))
            .otherwise(F.concat(F.lit(OVERALL_ERROR), err)).alias("overall_remarks"),
            F.when(ok, F.col("r.improvements")).otherwise(F.lit("")).alias("improvements"),
        ).alias("evaluation"),
        F.col("r.test_case_id").alias("reply_case_id"),
        # the report row carries the reply's id; an error row the request's
        F.when(ok, F.col("r.test_case_id")).otherwise(F.col("case_id")).alias("report_case_id"),
        *carry,
    )


def completeness_evaluator(pdf: pd.DataFrame) -> pd.Series:
    """A small deterministic Python evaluator (stands in for a remote service in tests and
    examples): each criterion passes when its text is non-empty. Whole columns at a time: a
    reply depends on the id and three flags, so it is an id between two of eight texts."""
    def present(column: str) -> pd.Series:
        if column not in pdf:
            return pd.Series(False, index=pdf.index)
        return pdf[column].notna() & (pdf[column] != "")

    def rest(flags: tuple[bool, ...]) -> str:
        n = sum(flags)
        verdict = "Passed" if n == 3 else ("Failed" if n == 0 else "Needs Improvement")
        body = {**{k: {"passed": v, "remarks": "" if v else "empty"}
                   for k, v in zip(("preconditions", "test_steps", "expected_results"), flags)},
                "verdict": verdict, "overall_remarks": f"{n} of 3 criteria present",
                "improvements": ""}
        return ", " + json.dumps(body)[1:] + "\n```"
    pattern = (present("pre_conditions") * 4 + present("test_steps") * 2
               + present("expected_result") * 1)
    rests = pattern.map({i: rest((bool(i & 4), bool(i & 2), bool(i & 1))) for i in range(8)})
    return '```json\n{"test_case_id": ' + pdf["case_id"].astype(str).map(json.dumps) + rests


# ------------------------------------------------------------------ report rows ----------

def result_rows(scored: DataFrame, title_col: str | None = "title",
                id_col: str = "case_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The 11-column validation report from an ``evaluation`` struct, after the ``keep``
    columns."""
    e = lambda f: F.col(f"evaluation.{f}")
    title = F.col(title_col) if title_col and title_col in scored.columns else F.lit(None).cast("string")
    return scored.select(
        *keep, F.col(id_col).cast("string").alias("Test Case ID"),
        title.alias("Title"),
        e("preconditions.passed").alias("Preconditions Passed"),
        e("preconditions.remarks").alias("Preconditions Remarks"),
        e("test_steps.passed").alias("Test Steps Passed"),
        e("test_steps.remarks").alias("Test Steps Remarks"),
        e("expected_results.passed").alias("Expected Results Passed"),
        e("expected_results.remarks").alias("Expected Results Remarks"),
        e("verdict").alias("Verdict"),
        e("overall_remarks").alias("Overall Remarks"),
        e("improvements").alias("Improvements"),
    )
