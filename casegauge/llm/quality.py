"""Quality rules: a rule bitmask ledger (DataFrame functions only).

``ledger`` evaluates every rule once per document and stores the measurements and one
bit per failed rule. Policies are versions of "which rules count": ``apply_policy`` is a
bit test, ``ablation`` one aggregate over the distinct bit patterns -- neither reads a
text again.

Defined results: a null text counts as empty (0 words, fails ``few_words``); repeated
rows are judged one by one; an empty table gives an empty ledger; columns besides the id
and the text take no part, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegauge.llm.common import WORD

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Rule -> bit. New rules get new bits; bits are never reused, so that
# stored ledgers stay readable by later policies.
RULES = ("few_words", "repeated_words", "symbols", "duplicate_lines", "word_length")


def bit(rule: str) -> int:
    return 1 << RULES.index(rule)


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a document is rejected if it fails any of ``rules``."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(r) for r in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
POLICY_V1 = Policy("v1", ("few_words", "repeated_words", "symbols", "duplicate_lines",
                          "word_length"))
POLICIES = (BASE, POLICY_V1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def _windows(words: Column, n: Column, exact: bool) -> Column:
    """The 5-word windows of a word array: as 64-bit hashes, or as joined words."""
    def window(i: Column) -> Column:
        if exact:
            return F.array_join(F.slice(words, i + 1, WINDOW), " ")
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    return F.when(n < WINDOW, F.array().cast("array<string>" if exact else "array<bigint>")) \
            .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
                                   window))


def _covered(windows: Column) -> Column:
    """Words that lie in windows found twice or more. The windows are sorted with their
    positions; equal neighbours are repeats; their positions, sorted again, each add the
    words that the previous repeat doesn't reach."""
    def repeats(s: Column) -> Column:
        return F.filter(s, lambda x, j: (F.get(s, j - 1)["w"] == x["w"])
                        | (F.get(s, j + 1)["w"] == x["w"]))
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"),
                                                                     i.alias("i"))))
    positions = F.sort_array(F.transform(_let(placed, repeats), lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).cast("int").alias("last"),
                     F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        positions, start,
        lambda a, p: F.struct(p.alias("last"),
                              (a["n"] + F.least(F.lit(WINDOW), p - a["last"]))
                              .cast("bigint").alias("n")),
        lambda a: a["n"])


def _repeat_words(words: Column) -> Column:
    """Equal windows have equal hashes, so texts whose window hashes all differ have no
    repeat; only the others build the windows' words, and count exactly."""
    def count(w: Column) -> Column:
        n = F.size(w)
        has = _let(_windows(w, n, False),
                   lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(has, _covered(_windows(w, n, True))).otherwise(F.lit(0).cast("bigint"))
    return _let(words, count)


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), t.alias("t"))
    staged = docs.select(
        "doc_id",
        F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long")
        .alias("n_symbols"))
    return staged.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w))
        .alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
        .alias("n_dup_lines"),
        F.when(F.size("words") <= WINDOW, F.lit(0).cast("bigint"))
        .otherwise(_repeat_words(F.col("words"))).alias("n_repeat_words"))


def rule_columns(symbol_pct: int = 75, dup_line_min: int = 5, min_chars: int = 2,
                 max_chars: int = 40) -> dict[str, Column]:
    """Each rule as a boolean over the measurements (true: failed), in integers."""
    n = F.col("n_words")
    return {
        "few_words": n < 10,
        "repeated_words": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 100 * F.col("n_symbols") > symbol_pct * n,
        "duplicate_lines": (F.col("n_dup_lines") >= dup_line_min)
        & (20 * F.col("n_dup_lines") > n),
        "word_length": (F.col("word_chars") < min_chars * n)
        | (F.col("word_chars") > max_chars * n),
    }


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **limits: int) -> DataFrame:
    """Measurements and ``failed`` (bit k set: rule k of ``RULES`` failed), one row per
    document; every rule is evaluated once."""
    bits = sum((F.when(c, F.lit(bit(r))).otherwise(F.lit(0))
                for r, c in rule_columns(**limits).items()), F.lit(0))
    return measure(df, id_col, text_col).withColumn("failed", bits.cast("int"))


def fails(policy: Policy) -> Column:
    """True for ledger rows that the policy rejects."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` under a policy version."""
    return rows.withColumn("kept", ~fails(policy)) \
               .withColumn("policy", F.lit(policy.version))


def ablation(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule in it: documents that fail the rule, that fail no other rule of
    the policy (kept if the rule were left out), and that the policy rejects. The ledger
    is first counted by bit pattern (at most 2**rules groups, summed map-side)."""
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    kinds = F.explode(F.array(*[
        F.struct(F.lit(p.version).alias("policy"), F.lit(r).alias("rule"),
                 F.lit(bit(r)).alias("bit"), F.lit(p.mask).alias("mask"))
        for p in policies for r in p.rules]))
    hit = F.col("failed").bitwiseAND(F.col("k.mask"))
    return patterns.select("failed", "n", kinds.alias("k")).groupBy(
        F.col("k.policy").alias("policy"), F.col("k.rule").alias("rule")).agg(
        F.sum(F.when(hit.bitwiseAND(F.col("k.bit")) != 0, F.col("n")).otherwise(0))
        .alias("n_failed"),
        F.sum(F.when(hit == F.col("k.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("n_rejected"))


def keep_good(df: DataFrame, policy: Policy = POLICY_V1, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``df`` (all its columns) that the policy keeps. Judged row by row, in
    one pass without a shuffle: the row rides along as one struct through the ledger."""
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                    F.col(f"`{text_col}`").alias("text"))
    judged = ledger(row, "row", "text")
    return judged.where(~fails(policy)).select("doc_id.*")
