"""Report queries: totals, breakdowns, counters, facets, filters and display labels
(G1-G5, G8, G9, G11, P16-P19, P22, O4).

All aggregates are single grouped aggregations with map-side partial aggregation, so a
hot group costs one partial row per input partition, never a skewed task.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegauge.functions.html import py_strip

VERDICTS = ("Passed", "Needs Improvement", "Failed")


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def totals(report: DataFrame, verdict_col: str = "General Standards") -> DataFrame:
    """G1 + G2 + F19: total / passed / failed (= total - passed) and the pass rate (safe
    division: 0 when empty), shown as a whole percent."""
    v = F.col(verdict_col)
    agg = report.agg(F.count(F.lit(1)).alias("total"), _count_if(v == "Passed").alias("passed"))
    rate = F.coalesce(F.try_divide(F.col("passed"), F.col("total")), F.lit(0.0))
    return agg.select(
        "total", "passed", (F.col("total") - F.col("passed")).alias("failed"),
        F.round(rate, 6).alias("pass_rate"),
        F.format_string("%d%%", F.bround(rate * 100).cast("long")).alias("pass_rate_text"),
    )


def criterion_of_remark(part: Column) -> Column:
    """the reference's text rule -- the part before the first ``" = "``, or
    ``Priority/Risk`` for a remark starting with ``priority``, else the remark itself."""
    p = py_strip(part)
    return (F.when(F.instr(p, " = ") > 0, py_strip(F.substring_index(p, " = ", 1)))
            .when(F.lower(p).startswith("priority"), F.lit("Priority/Risk"))
            .otherwise(p))


def failure_breakdown(evaluated: DataFrame, compat: bool = False,
                      verdict_col: str = "verdict", remarks_col: str = "remarks",
                      failures_col: str = "failures") -> DataFrame:
    """How often each criterion made a record fail, most frequent first.

    Default: count the structured ``failures`` array (no text parsing). ``compat=True``
    re-derives the criterion from the remark text exactly as the reference does,
    including its ``Testing Phase =`` category for an empty phase list.
    """
    failed = evaluated.where(F.col(verdict_col) == "Failed")
    if compat:
        parts = failed.select(F.explode(F.split(F.coalesce(F.col(remarks_col), F.lit("")), ";"))
                              .alias("part"))
        crit = (parts.select(py_strip(F.col("part")).alias("part"))
                .where(F.col("part") != "")
                .select(criterion_of_remark(F.col("part")).alias("criterion")))
    else:
        crit = failed.select(F.explode(failures_col).alias("f")).select(
            F.col("f.rule").alias("criterion"))
    return (crit.groupBy("criterion").agg(F.count(F.lit(1)).alias("failed_cases"))
            .orderBy(F.desc("failed_cases"), "criterion"))


def verdict_frequency(df: DataFrame, col: str = "verdict") -> DataFrame:
    """Value counts of the verdict, NULL dropped, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), col))


def verdict_counters(df: DataFrame, col: str = "verdict",
                     never_scored: Column | None = None) -> DataFrame:
    """One row of counters; ``errors`` counts NULL verdicts (which, in the latest view,
    includes never-scored records -- reported separately as ``never_scored``)."""
    v = F.col(col)
    aggs = [F.count(F.lit(1)).alias("total"),
            _count_if(v == "Passed").alias("passed"),
            _count_if(v == "Needs Improvement").alias("needs_improvement"),
            _count_if(v == "Failed").alias("failed"),
            _count_if(v.isNull()).alias("errors")]
    if never_scored is not None:
        aggs.append(_count_if(never_scored).alias("never_scored"))
    return df.agg(*aggs)


def facets(df: DataFrame, cols=("tribe", "product", "capability")) -> DataFrame:
    """The distinct non-null values of each facet column, as ``(facet, value)``.

    One pass over ``df``: every row is unpivoted into its ``(facet, value)`` pairs and the
    distinct is a single grouped aggregate with map-side partial aggregation (a union of
    one projection per column would plan -- and compute -- ``df`` once per column).
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"),
                                         F.col(c).cast("string").alias("value")) for c in cols]))
    return (df.select(pairs.alias("p")).select("p.facet", "p.value")
            .where(F.col("value").isNotNull()).distinct().orderBy("facet", "value"))


def lenient_date(c: Column) -> Column:
    """F16: timestamp or ISO text -> date; unparsable -> NULL (a timestamp isn't printed and
    parsed again: the optimizer drops a cast to the type that a column already has)."""
    return F.to_date(c.try_cast("timestamp"))


def date_extent(df: DataFrame, col: str = "validated_at",
                today: _dt.date | None = None) -> DataFrame:
    """G9 + F17: min/max date of a column; with no dates, (today - 365 days, today)."""
    today = today or _dt.datetime.now(_dt.timezone.utc).date()
    d = lenient_date(F.col(col))
    return df.agg(F.min(d).alias("d0"), F.max(d).alias("d1")).select(
        F.coalesce("d0", F.date_sub(F.lit(today), 365)).alias("min_date"),
        F.coalesce("d1", F.lit(today)).alias("max_date"))


def equals_unless_all(col: str, value: str | None) -> Column | None:
    """An equality filter that the sentinel ``All`` (or None) switches off."""
    return None if value in (None, "All") else F.col(col) == value


def verdict_filter(value: str | None, col: str = "verdict") -> Column | None:
    """``Passed`` / ``Needs Improvement`` / ``Failed`` / ``Error(s)`` (NULL) / ``All``."""
    if value in (None, "All"):
        return None
    if value in ("Error", "Errors"):
        return F.col(col).isNull()
    return F.col(col) == value


def search(pattern: str | None, cols=("title", "case_id"), literal: bool = False) -> Column | None:
    """Case-insensitive search over several columns.

    As in the reference the pattern is a regular expression and is lower-cased together
    with the text; ``literal=True`` offers plain substring search instead.
    """
    if not pattern:
        return None
    p = pattern.lower()
    tests = [(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).contains(F.lit(p))
              if literal else
              F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).rlike(p)) for c in cols]
    return reduce(lambda a, b: a | b, tests)


def date_range(col: str, start: _dt.date | None, end: _dt.date | None) -> Column | None:
    """Inclusive date range; rows whose date is missing/unparsable drop out."""
    d = lenient_date(F.col(col))
    conds = []
    if start is not None:
        conds.append(d >= F.lit(start))
    if end is not None:
        conds.append(d <= F.lit(end))
    return reduce(lambda a, b: a & b, conds) if conds else None


def apply_filters(df: DataFrame, *conds: Column | None) -> DataFrame:
    """Compose optional predicates (``None`` = not set) into one pushed-down filter."""
    real = [c for c in conds if c is not None]
    return df.where(reduce(lambda a, b: a & b, real)) if real else df


# --- Fixed values: display labels of the report views. ---
VERDICT_BADGES = {
    "Passed": "✅ Passed",
    "Needs Improvement": "🔧 Needs Improvement",
    "Failed": "❌ Failed",
}
ERROR_BADGE = "⚠️ Error"
FLAG_LABELS = ("✅ Pass", "❌ Fail", "⚠️ Error")
# --- end of fixed values ---


def verdict_badge(c: Column) -> Column:
    """Verdict -> badge; NULL or any other value -> the error badge."""
    expr = F.when(F.lit(False), F.lit(None))
    for k, v in VERDICT_BADGES.items():
        expr = expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(ERROR_BADGE))


def flag_badge(c: Column) -> Column:
    """True/False/NULL flag -> Pass / Fail / Error badge."""
    return (F.when(c.isNull(), F.lit(FLAG_LABELS[2])).when(c, F.lit(FLAG_LABELS[0]))
            .otherwise(F.lit(FLAG_LABELS[1])))


def blank_as_dash(c: Column) -> Column:
    """Missing or empty metadata shows as an em dash (a value is shown as it is --
    only the empty string counts as blank, as in the report views)."""
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("—"))
