"""General-standards screen: decode, six metadata rules, verdict + remarks, flatten.

Everything is one projection over the records: no join, no shuffle, all expressions are
JVM built-ins inside whole-stage codegen. Rules are null-safe: a NULL or unknown code
fails its rule and prints ``None``; an absent/NULL phase list is treated as empty.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.functions import html
from casegauge.operators import ordering
from casegauge.sources import codemaps as cm

REPORT_COLUMNS = [
    "General Standards", "Remarks", "Test Case ID", "Title", "Project Initiative", "Tribe",
    "Product", "Capability", "Priority", "Automatability", "Automation Status", "Testing Type",
    "Status", "Testing Phase", "Pre Conditions", "Test Steps", "Expected Result",
]

FAILURE_TYPE = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("remark", T.StringType()),
])


@dataclass(frozen=True)
class Rule:
    """One row of the rule table: ``kind`` is ``in`` (scalar code), ``any`` (array of codes)
    or ``present`` (not null)."""
    name: str
    column: str
    kind: str
    mapping: dict = field(default_factory=dict)
    allowed_labels: frozenset = frozenset()
    map_name: str = ""

    @property
    def allowed_ids(self) -> list[int]:
        return cm.ids_with_labels(self.mapping, set(self.allowed_labels))


# --- Fixed values: the six standards, in the order their remarks are printed. ---
RULES = (
    Rule("Automatability", "custom_automatability", "in", cm.AUTOMATABILITY,
         frozenset({"Automatable", "To be Determined"}), "AUTOMATABILITY_MAP"),
    Rule("Testing Type", "custom_testing_type", "in", cm.TESTING_TYPE, frozenset({"web"}),
         "TESTING_TYPE_MAP"),
    Rule("Automation Status", "custom_automation_status", "in", cm.AUTOMATION_STATUS,
         frozenset({"Not Started", "Reviewed = Passed DOR"}), "AUTOMATION_STATUS_MAP"),
    Rule("Status", "case_status_id", "in", cm.STATUS, frozenset({"New", "Reviewed", "Active"}),
         "STATUS_MAP"),
    Rule("Priority/Risk", "priority_id", "present"),
    Rule("Testing Phase", "custom_testing_phase", "any", cm.TESTING_PHASE,
         frozenset({"BE Regression", "FE Regression", "Regression"}), "TESTING_PHASE_MAP"),
)
# --- end of fixed values ---


def rules_for(maps: dict[str, dict[int, str]]) -> tuple[Rule, ...]:
    """The six rules over a deployment's dictionaries: their allowed labels are resolved
    to the ids that these give them."""
    return tuple(replace(r, mapping=maps[r.map_name]) if r.map_name else r for r in RULES)


def phase_codes(df_col: Column) -> Column:
    """NULL phase list -> empty list (the screen never aborts on a missing list)."""
    return F.coalesce(df_col, F.array().cast("array<int>"))


def phase_text(codes: Column, mapping: dict[int, str] = cm.TESTING_PHASE) -> Column:
    """F9 + J2: decode every phase id and join with ``", "``."""
    return F.array_join(cm.decode_array(mapping, phase_codes(codes)), ", ")


PHASE_TEXT = "__phase_text"


def rule_parts(rule: Rule) -> tuple[Column, Column, Column]:
    """``(ok, value, remark)`` of one rule as codegen-able built-ins (no lambdas).

    ``ok`` is never NULL: a NULL or unknown code fails. The ``any`` rule reads its printed
    value from the ``PHASE_TEXT`` column staged by :func:`evaluate`.
    """
    c = F.col(rule.column)
    if rule.kind == "present":
        ok = c.isNotNull()
        value = F.lit(None).cast("string")
        remark = F.lit(f"{rule.name} is null")
    elif rule.kind == "in":
        ok = F.coalesce(c.isin(*rule.allowed_ids), F.lit(False))
        value = F.coalesce(cm.decode(rule.mapping, c), F.lit("None"))
        remark = F.concat(F.lit(f"{rule.name} = "), value)
    elif rule.kind == "any":
        # F9 "any": arrays_overlap (codegen) instead of a lambda over the list
        allowed = F.array(*[F.lit(i) for i in rule.allowed_ids]).cast("array<int>")
        ok = F.coalesce(F.arrays_overlap(phase_codes(c), allowed), F.lit(False))
        value = F.col(PHASE_TEXT)
        remark = F.concat(F.lit(f"{rule.name} = "), value)
    else:
        raise ValueError(rule.kind)
    return ok, value, remark


def rule_failure(rule: Rule) -> Column:
    """A ``struct(rule, value, remark)`` when the rule fails, else NULL."""
    ok, value, remark = rule_parts(rule)
    return F.when(~ok, F.struct(F.lit(rule.name).alias("rule"), value.alias("value"),
                                remark.alias("remark")))


def evaluate(raw: DataFrame, rules=RULES, keep_phase_text: bool = False) -> DataFrame:
    """Add ``remarks``, ``verdict`` and ``failures`` (array of structs, rule order).

    ``remarks`` is the ``"; "``-joined text of the failed rules (``concat_ws`` skips the
    passing ones); ``verdict`` is ``Passed`` iff every rule holds. Both are plain built-ins,
    so the screen stays inside whole-stage codegen; the only array mapping (decoding the
    phase list) is staged once per row. The structured ``failures`` array is kept for the
    breakdown, so reports never re-parse text; it is pruned when not selected.
    """
    phases = next((r.mapping for r in rules if r.kind == "any"), cm.TESTING_PHASE)
    staged = raw.withColumn(PHASE_TEXT, phase_text(F.col("custom_testing_phase"), phases))
    parts = [rule_parts(r) for r in rules]
    all_ok = reduce(lambda a, b: a & b, [ok for ok, _, _ in parts])
    failures = F.filter(F.array(*[rule_failure(r) for r in rules]), lambda x: x.isNotNull())
    out = (staged.withColumn("failures", failures)
           .withColumn("remarks", F.concat_ws("; ", *[F.when(~ok, rm) for ok, _, rm in parts]))
           .withColumn("verdict", F.when(all_ok, "Passed").otherwise("Failed")))
    return out if keep_phase_text else out.drop(PHASE_TEXT)


def steps_text(steps: Column, part: str) -> Column:
    """gather one field of every step and join by newline; NULL field -> ''."""
    return F.array_join(F.transform(F.coalesce(steps, F.array()),
                                    lambda s: F.coalesce(s[part], F.lit(""))), "\n")


def steps_text_by_key(rows: DataFrame, key: str, order: str, parts: dict[str, str],
                      chunk: int = 1024) -> DataFrame:
    """F10 when the steps arrive one row per step (a long table) instead of nested in
    the record: for each output name in ``parts`` (``{output: step column}``), that column
    of every step joined by newline in ``order`` order (integral), per ``key``.

    Two grouped aggregates instead of one collect per key: steps are first gathered per
    ``(key, order // chunk)`` into nested step arrays (the D4 shape) and joined by
    :func:`steps_text`, so the steps of a record holding a third of all rows are sorted
    and joined by many tasks in parallel; the second aggregate only concatenates each
    key's chunk texts in chunk order. Joining chunk texts by newline equals joining all
    steps (empty fields stay as empty lines).
    """
    fields = list(parts.values())
    step = F.struct(F.col(order).alias("__o"), *[F.col(c).alias(c) for c in fields])
    chunks = (rows.groupBy(key, F.floor(F.col(order) / chunk).alias("__chunk"))
              .agg(F.sort_array(F.collect_list(step)).alias("__steps")))
    texts = chunks.select(key, "__chunk", *[steps_text(F.col("__steps"), c).alias(c)
                                             for c in dict.fromkeys(fields)])
    per_key = (texts.groupBy(key)
               .agg(F.sort_array(F.collect_list(F.struct("__chunk", *dict.fromkeys(fields))))
                    .alias("__c")))
    def field(c: str):
        return lambda x: x[c]
    return per_key.select(key, *[F.array_join(F.transform("__c", field(c)), "\n").alias(out)
                                 for out, c in parts.items()])


def flatten(raw: DataFrame, tribe: Column | None = None, product: Column | None = None,
            capability: Column | None = None,
            maps: dict[str, dict[int, str]] = cm.SMALL_MAPS) -> DataFrame:
    """One raw record -> the 17-column report row (plus ``failures`` and
    ``list_lost``).

    ``tribe``/``product``/``capability`` are label columns already decoded by the caller
    (see ``codemaps.decode_with_dimension``); by default they stay NULL, as they do when
    the retrieval dictionaries are empty. ``maps``: the dictionaries of the standards (see
    ``codemaps.standards_maps``).

    The joined step texts are staged in their own projection: the HTML functions read them
    several times.

    N13: preconditions and steps keep only their list items, so a text written without
    ``<li>`` markup becomes empty (as in the reference); ``list_lost`` flags the rows where
    that dropped visible text. It is computed only when selected.
    """
    ev = evaluate(raw, rules_for(maps), keep_phase_text=True)
    null = F.lit(None).cast("string")
    ev = ev.withColumns({"__steps_html": steps_text(F.col("custom_steps_separated"), "content"),
                         "__expected_html": steps_text(F.col("custom_steps_separated"), "expected")})
    staged = ev.select(
        F.col("verdict").alias("General Standards"),
        F.col("remarks").alias("Remarks"),
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("Test Case ID"),
        F.col("title").alias("Title"),
        html.html_to_text(F.col("custom_project_initiative")).alias("Project Initiative"),
        (tribe if tribe is not None else null).alias("Tribe"),
        (product if product is not None else null).alias("Product"),
        (capability if capability is not None else null).alias("Capability"),
        F.col("priority_id").cast("int").alias("Priority"),
        cm.decode(maps["AUTOMATABILITY_MAP"], F.col("custom_automatability")).alias("Automatability"),
        cm.decode(maps["AUTOMATION_STATUS_MAP"], F.col("custom_automation_status")).alias("Automation Status"),
        cm.decode(maps["TESTING_TYPE_MAP"], F.col("custom_testing_type")).alias("Testing Type"),
        cm.decode(maps["STATUS_MAP"], F.col("case_status_id")).alias("Status"),
        F.col(PHASE_TEXT).alias("Testing Phase"),
        html.numbered_list(F.col("custom_preconds")).alias("Pre Conditions"),
        html.numbered_list(F.col("__steps_html")).alias("Test Steps"),
        html.html_to_text(F.col("__expected_html")).alias("Expected Result"),
        "failures",
        F.col("custom_preconds").alias("__pre_html"),
        "__steps_html",
    )
    lost = lambda shown, src: (F.col(shown) == "") & (html.html_to_text(F.col(src)) != "")
    return staged.withColumn("list_lost", lost("Pre Conditions", "__pre_html")
                             | lost("Test Steps", "__steps_html")).drop("__pre_html", "__steps_html")


def passed_only(report: DataFrame) -> DataFrame:
    """Keep rows whose general-standards verdict is ``Passed``."""
    return report.where(F.col("General Standards") == "Passed")


def report_order(report: DataFrame) -> DataFrame:
    """O1: Passed before Failed, then the id *as text* (``C10`` sorts before ``C9``)."""
    return report.orderBy(*_report_order())


def _report_order() -> list[Column]:
    return [F.when(F.col("General Standards") == "Passed", 0).otherwise(1), F.col("Test Case ID")]


def report_positions(report: DataFrame) -> DataFrame:
    """O1 as a column: each row's ``position`` in the report."""
    return ordering.numbered(report, _report_order())
