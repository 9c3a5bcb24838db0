"""Similar already-scored examples for every record at once.

Per record the reference asks: up to ``target`` scored records from the same capability
(self excluded); if fewer than ``min_per_level`` were found, top up from the same product,
then from the same tribe, never repeating one. Instead of one query per record, this is
one set-based job:

1. per level, a *pool* of the first ``K = target + min_per_level`` scored records of each
   group in a seeded pseudo-random order (``md5(seed|id)``; ``row_number <= K`` lets Spark
   cut each group to K rows before the shuffle);
2. each record joins its three pools, one array of at most K examples per group and level
   (each level broadcast on its own when a size check allows), drops itself, and keeps each
   candidate at its lowest level, inside the row;
3. closed-form quotas ``t1 = min(c1, T)``, ``t2 = t1 < M ? min(c2, T - t1) : 0``,
   ``t3 = t1 + t2 < M ? min(c3, T - t1 - t2) : 0`` pick the first ``t_i`` of level i.

K rows per group suffice: a lower level is consulted only when fewer than M candidates
came from above, so at most M - 1 others plus the record itself are excluded from a
pool. A record therefore meets at most 3K candidates however large its groups are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegauge.operators import joins

LEVELS = ("capability", "product", "tribe")


def order_key(seed: str, id_col: str = "case_id"):
    """A reproducible stand-in for ``ORDER BY RANDOM()``."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def pools(scored: DataFrame, k: int, seed: str, levels=LEVELS, carry=()) -> DataFrame:
    """The first ``k`` scored records of every group of every level:
    ``(level, grp, example_id, okey, verdict, *carry)``.

    One pass over ``scored``: each record is unpivoted into its ``(level, grp)`` pairs and
    one window over ``(level, grp)`` keeps ``k`` rows; ``row_number <= k`` lets Spark cut
    every group to ``k`` rows per map task before the shuffle (``WindowGroupLimit``).
    """
    carry = [c for c in carry if c not in ("case_id", "verdict")]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("level"), F.nullif(F.col(c), F.lit("")).alias("grp"))
        for i, c in enumerate(levels, start=1)])).alias("l")
    g = (scored.select(F.col("case_id").alias("example_id"), "verdict", *carry, pairs)
         .select("l.level", "l.grp", "example_id", "verdict", *carry)
         .where(F.col("grp").isNotNull())
         .withColumn("okey", order_key(seed, "example_id")))
    w = Window.partitionBy("level", "grp").orderBy("okey", "example_id")
    return (g.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k)
            .select("level", "grp", "example_id", "okey", "verdict", *carry))


def group_pools(scored: DataFrame, target: int = 5, min_per_level: int = 3, seed: str = "seed",
                levels=LEVELS, carry=()) -> DataFrame:
    """The pools as one row per group, ``(level, grp, pool)``, computed once: an array of at
    most K examples in their seeded order."""
    carry = [c for c in carry if c not in ("case_id", "verdict")]
    return joins.materialize(
        pools(scored, target + min_per_level, seed, levels, carry).groupBy("level", "grp").agg(
            F.sort_array(F.collect_list(F.struct("okey", "example_id", "verdict", *carry)))
            .alias("pool")))


def similar_examples(records: DataFrame, scored: DataFrame | None, target: int = 5,
                     min_per_level: int = 3, seed: str = "seed", levels=LEVELS,
                     max_broadcast_rows: int = joins.DEFAULT_BROADCAST_ROWS,
                     carry=(), members: DataFrame | None = None) -> DataFrame:
    """``(case_id, example_id, level, ordinal, verdict, *carry)`` for every record.

    ``records``: ``case_id`` + the level columns. ``scored``: the same for records whose
    latest score has a verdict, plus ``verdict`` (see ``store.latest_per_key``; use the
    dedup form so a record is one candidate) and any ``carry`` columns -- the example's
    own details (title, flags), which ride along in the bounded pools. Carrying them is
    what keeps the use of the examples skew-free: every record of a hot group is given the
    same few pool members, so joining details back on ``example_id`` afterwards would
    send a third of all example rows to one key.

    ``members``: the result of ``group_pools`` (same arguments), for several calls on the same
    pools; then ``scored`` isn't read.

    A pool is one row per group holding an array of at most ``K`` examples. Each level's
    table is joined on its own (broadcast if its own size allows), and the quotas are taken
    inside the row, so neither records nor candidates are shuffled where the pools are
    broadcast, and only the chosen examples (at most ``target``) leave the row.
    """
    carry = [c for c in carry if c not in ("case_id", "verdict")]
    if members is None:
        members = group_pools(scored, target, min_per_level, seed, levels, carry)
    now = records.select("case_id", *[F.nullif(F.col(c), F.lit("")).alias(f"__g{i}")
                                      for i, c in enumerate(levels, start=1)])
    for i in range(1, len(levels) + 1):
        pool, _ = joins.broadcast_if_small(
            members.where(F.col("level") == i)
            .select(F.col("grp").alias(f"__g{i}"), F.col("pool").alias(f"__p{i}")),
            max_broadcast_rows)
        now = now.join(pool, f"__g{i}", "left")
    # per level: the pool without the record itself and without what an earlier level has;
    # level 1 takes min(c1, T), a lower one is consulted only while fewer than M were taken
    now = now.withColumns({"__seen": F.array("case_id"), "__n": F.lit(0)})
    for i in range(1, len(levels) + 1):
        pool = F.coalesce(F.col(f"__p{i}"), F.array().cast(members.schema["pool"].dataType))
        now = now.withColumn(f"__p{i}", F.filter(
            pool, lambda x: ~F.array_contains(F.col("__seen"), x["example_id"])))
        now = now.withColumn("__seen", F.concat("__seen", F.transform(
            f"__p{i}", lambda x: x["example_id"])))
        room = F.least(F.size(f"__p{i}"), F.lit(target) - F.col("__n"))
        quota = room if i == 1 else F.when(F.col("__n") < min_per_level, room).otherwise(0)
        now = now.withColumn("__q", quota)
        now = now.withColumn(f"__p{i}", F.slice(F.col(f"__p{i}"), F.lit(1), F.col("__q")))
        now = now.withColumn("__n", F.col("__n") + F.col("__q"))
    # 1-based example ordinals, capability examples first
    levelled = [F.transform(f"__p{i}", _with_level(i)) for i in range(1, len(levels) + 1)]
    out = now.select("case_id", F.posexplode(F.concat(*levelled)).alias("__i", "e"))
    return out.select("case_id", "e.x.example_id", "e.level",
                      (F.col("__i") + 1).cast("long").alias("ordinal"), "e.x.verdict",
                      *[F.col(f"e.x.`{c}`").alias(c) for c in carry])


def _with_level(level: int):
    return lambda x: F.struct(F.lit(level).alias("level"), x.alias("x"))


# The example's own details shown in its block (carried through the pools).
EXAMPLE_DETAILS = ("title", "capability", "product", "tribe", "pre_conditions", "test_steps",
                   "expected_result", "preconditions_passed", "preconditions_remarks",
                   "test_steps_passed", "test_steps_remarks", "expected_results_passed",
                   "expected_results_remarks", "overall_remarks", "improvements")

# --- Fixed values: layout of the reference-examples section of the evaluator prompt, a template
# per line; {} is a value. ---
EXAMPLES_HEADER = "\n## Reference Examples (similar validated cases — for calibration only)\n"
EXAMPLE = "### Example {} — {} [{}]  _(context: {})_"
TITLE = "**Title:** {}"
PRE = "**Pre Conditions:**"
STEPS = "**Test Steps:**"
EXPECTED = "**Expected Result:**"
EVALUATION = "**Evaluation:**"
CRITERION = "- {}: {}"
CRITERION_REMARK = "- {}: {} — {}"
VERDICT = "- **Verdict: {}**"
OVERALL = "- Overall Remarks: {}"
IMPROVEMENTS = "- Improvements: {}"
EXAMPLES_FOOTER = "---"
CRITERIA = ("Pre Conditions", "Test Steps", "Expected Results")
PASS_ICON = "✓"
FAIL_ICON = "✗"
EMPTY_TEXT = "(empty)"
ERROR_VERDICT = "ERROR"
NO_TITLE = "None"
# --- end of fixed values ---


def filled(template: str, *values: Column) -> Column:
    """A template with its ``{}`` replaced by values, in order; NULL if one of them is."""
    first, *rest = template.split("{}")
    return F.concat(F.lit(first), *[x for v, text in zip(values, rest, strict=True)
                                    for x in (v.cast("string"), F.lit(text))])


def example_block(cols: set[str]) -> Column:
    """one example's lines, newline-joined and ending in an empty line. Optional
    lines (a criterion's remark, overall remarks, improvements) appear only when
    non-empty; empty texts print ``(empty)``; a NULL title prints ``None``."""
    def c(name: str) -> Column:
        return F.col(name) if name in cols else F.lit(None).cast("string")

    def nonblank(name: str) -> Column:
        return F.nullif(c(name).cast("string"), F.lit(""))

    def criterion(label: str, flag: str, remarks: str) -> Column:
        icon = F.when(F.coalesce(c(flag).cast("boolean"), F.lit(False)), F.lit(PASS_ICON)) \
            .otherwise(F.lit(FAIL_ICON))
        return F.coalesce(filled(CRITERION_REMARK, F.lit(label), icon, nonblank(remarks)),
                          filled(CRITERION, F.lit(label), icon))

    verdict = F.coalesce(nonblank("verdict"), F.lit(ERROR_VERDICT))
    context = F.coalesce(nonblank("capability"), nonblank("product"), nonblank("tribe"), F.lit(""))
    return F.concat_ws(
        "\n",
        filled(EXAMPLE, F.col("ordinal"), F.col("example_id"), F.upper(verdict), context),
        filled(TITLE, F.coalesce(c("title").cast("string"), F.lit(NO_TITLE))),
        F.lit(""),
        F.lit(PRE), F.coalesce(nonblank("pre_conditions"), F.lit(EMPTY_TEXT)),
        F.lit(""),
        F.lit(STEPS), F.coalesce(nonblank("test_steps"), F.lit(EMPTY_TEXT)),
        F.lit(""),
        F.lit(EXPECTED), F.coalesce(nonblank("expected_result"), F.lit(EMPTY_TEXT)),
        F.lit(""),
        F.lit(EVALUATION),
        criterion(CRITERIA[0], "preconditions_passed", "preconditions_remarks"),
        criterion(CRITERIA[1], "test_steps_passed", "test_steps_remarks"),
        criterion(CRITERIA[2], "expected_results_passed", "expected_results_remarks"),
        filled(VERDICT, verdict),
        filled(OVERALL, nonblank("overall_remarks")),
        filled(IMPROVEMENTS, nonblank("improvements")),
        F.lit(""))


def few_shot_context(examples: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """the reference-examples prompt section per record, examples in ordinal order:
    the header, one block per example, then ``---``.

    ``examples`` should carry the ``EXAMPLE_DETAILS`` columns (``similar_examples(...,
    carry=EXAMPLE_DETAILS)``); then this is one grouped aggregate by record. ``details``
    (``case_id`` + those columns) is the fallback for examples without them: a join on
    ``example_id``, left to AQE's skew split. Absent detail columns count as NULL. Each
    record has at most ``target`` examples, so the per-record collection is bounded;
    records without examples get no row (their section is empty).
    """
    if details is None:
        j = examples
    else:
        have = [x for x in EXAMPLE_DETAILS if x in details.columns]
        d = details.select(F.col("case_id").alias("example_id"), *have)
        j = examples.drop(*[x for x in have if x in examples.columns]) \
            .join(d, "example_id", "left")
    block = example_block(set(j.columns))
    blocks = (j.groupBy("case_id")
              .agg(F.sort_array(F.collect_list(F.struct("ordinal", block.alias("b")))).alias("bs")))
    body = F.array_join(F.col("bs.b"), "\n")
    return blocks.select("case_id", F.concat(F.lit(EXAMPLES_HEADER + "\n"), body,
                                             F.lit("\n" + EXAMPLES_FOOTER + "\n")).alias("context"))
