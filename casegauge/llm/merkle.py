"""Merkle manifest of a dataset: a tree of digests per group, one root over the groups.

``H`` is the lowercase hex SHA-256 of its inputs put together, digests as hex text. A row's
leaf is H of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.

* ``placed``: the leaves of a group ascend by id. Rows are range-partitioned and sorted by
  (group, id, leaf); the first place of each (partition, group) is added to its group's counts
  in the partitions before, so that no group is numbered in one task.
* ``tree``: per level, every node sends its digest to the computed indices of its siblings
  (index XOR 1 for two children, the other slot offsets of its run otherwise); an equijoin on
  (group, index) with the nodes themselves gives each node its siblings, and the slot-zero rows
  emit the parents. A group leaves when one node remains: its subroot.
* ``paths``: downwards, every node joins its parent's path on (group, parent index), so a
  path is shuffled once per run of siblings instead of once per leaf.

The subroots, in group order, go through the same tree and give the root. Keys of all joins
are single nodes: a group with a third of all rows is as spread as any other. Only row counts,
the height of the tree and the one root reach the driver. Every level is a written table, so a
lost executor costs tasks of one level.

Defined results: a null id sorts first and isn't tampered with; a null group comes first (before
the empty one), then bytewise order; rows that repeat an id stand in the order of their
leaves, equal rows are leaves of their own; an empty table gives an empty manifest; a
single row's subroot and root are its leaf and its proof is H of nothing; extra columns take
no part. Texts enter whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegauge.llm.common import Scratch, few
from casegauge.operators.joins import broadcast_if_small

ARITY = 8
NODES = 1 << 15  # rows that one task places
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def none() -> Column:
    return F.lit("").cast("binary")


def digest_of(value: Column) -> Column:
    """H of text, or of packed digests given as their hex text; packed (32 bytes)."""
    return F.unhex(F.sha2(value.cast("binary"), 256))


def hex_text(packed: Column) -> Column:
    return F.lower(F.hex(packed))


def leaf(fields: list[Column]) -> Column:
    """Packed digest of a row: its fields with their lengths, so that no two rows collide."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return digest_of(F.concat(*parts))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def group_key(group: Column) -> Column:
    """A key without nulls that sorts as (null first, UTF-8 bytewise)."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


# ----------------------------------------------------------------------------
# Places within groups
# ----------------------------------------------------------------------------

def placed(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` (column ``g``: group) with ``i``, the 0-based place in the group by
    ``order``, and ``n``, the group's rows."""
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    count = rows.count()
    dealt = rows.coalesce(1) if count <= NODES else rows.repartitionByRange(*keys)
    sorted_rows = scratch.stage(dealt.sortWithinPartitions(*keys).withColumn(
        "at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("at", 33)
    runs = sorted_rows.groupBy(part.alias("part"), "g").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    group = Window.partitionBy("g")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.stage(few(runs.select(
        "part", "g",
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(group).alias("n")), count), "merkle-starts")
    small, _ = broadcast_if_small(starts)
    return sorted_rows.withColumn("part", part).join(small, ["part", "g"]) \
        .withColumn("i", F.col("at") + F.col("shift")).drop("part", "at", "shift")


# ----------------------------------------------------------------------------
# The tree, upwards and downwards
# ----------------------------------------------------------------------------

def siblings(i: Column, n: Column, arity: int) -> Column:
    """Indices of the other nodes of a node's run among ``n`` nodes."""
    if arity == 2:
        found = F.array(i.bitwiseXOR(F.lit(1).cast("long")))
        return F.filter(found, lambda x: x < n)
    base = i - i % arity
    return F.filter(F.sequence(base, F.least(base + (arity - 1), n - 1)), lambda x: x != i)


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (g, i, n, h and more) with ``l`` and ``r``: the packed digests of the siblings
    on their left and right, in order."""
    i = F.col("i")
    sent = nodes.select("g", F.explode(siblings(i, F.col("n"), arity)).alias("i"),
                        i.alias("from"), F.col("h").alias("sibling"))
    met = nodes.join(sent, ["g", "i"], "left").groupBy("g", "i", *[
        c for c in nodes.columns if c not in ("g", "i")]).agg(
        F.sort_array(F.collect_list(F.when(F.col("from").isNotNull(),
                                           F.struct("from", "sibling")))).alias("met"))

    def joined(side) -> Column:
        return F.aggregate(F.filter("met", side), none(),
                           lambda done, x: F.concat(done, x["sibling"]))
    return met.withColumn("l", joined(lambda x: x["from"] < i)) \
        .withColumn("r", joined(lambda x: x["from"] > i)).drop("met")


def tree(nodes: DataFrame, arity: int, scratch: Scratch) -> list[tuple[DataFrame, int]]:
    """Tables of all levels and about how many nodes they hold, from ``nodes`` (g, i, n, h and
    more) to the level at which every group is one node: g, i, n, h, l, r (and more at the
    lowest)."""
    size = nodes.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("nodes"),
                     F.count_if(F.col("i") == 0).alias("groups")).first()
    most, count = size["most"] or 0, size["nodes"]
    levels = []
    while True:
        if most > 1:
            level = with_siblings(nodes, arity)
        else:
            level = nodes.withColumn("l", none()).withColumn("r", none())
        level = scratch.stage(few(level, count), "merkle-level")
        levels.append((level, count))
        if most <= 1:
            return levels
        most, count = -(-most // arity), count // arity + size["groups"]
        run = F.concat("l", "h", "r")
        nodes = level.where((F.col("i") % arity == 0) & (F.col("n") > 1)).select(
            "g", F.expr(f"i div {arity}").alias("i"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest_of(hex_text(run)).alias("h"))


def subroots(levels: list[tuple[DataFrame, int]]) -> DataFrame:
    """The last node of every group: g, h."""
    out = None
    for level, _ in levels:
        last = level.where("n = 1").select("g", "h")
        out = last if out is None else out.unionByName(last)
    return out


def paths(levels: list[tuple[DataFrame, int]], tops: DataFrame, arity: int,
          scratch: Scratch) -> DataFrame:
    """The lowest level's rows with ``subroot`` and ``path``: an array of (l, r) from the
    node's own run up to the subroot, then on as ``tops`` (g, subroot, path) says. Higher
    levels are freed on the way."""
    above = None
    for k, (level, count) in reversed(list(enumerate(levels))):
        own = level.where("n = 1").join(tops, "g").drop("l", "r")
        if above is not None:
            parent = above.select("g", F.col("i").alias("p"), "subroot", F.col("path").alias("up"))
            below = level.where("n > 1").withColumn("p", F.expr(f"i div {arity}")) \
                .join(parent, ["g", "p"])
            path = F.concat(F.array(F.struct("l", "r")), F.col("up"))
            own = own.unionByName(below.withColumn("path", path).select(own.columns))
        if k == 0:
            return own
        higher, above = above, scratch.stage(few(own, count), "merkle-paths")
        scratch.drop(level, *([] if higher is None else [higher]))


# ----------------------------------------------------------------------------
# The operator
# ----------------------------------------------------------------------------

def manifest(df: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             group_col: str = "lang", arity: int = ARITY, tampered: dict | None = None,
             tamper: Column | None = None) -> tuple[DataFrame, str | None]:
    """A row per row of ``df``: ``id_col``, packed digests ``leaf``, ``changed`` (the leaf
    with the columns of ``tampered`` put in place where ``tamper`` holds, else null),
    ``subroot``, and its proof ``path`` (array of l, r: packed siblings on the left and
    right, level by level up to the root); and the root (hex; None for an empty table)."""
    scratch = Scratch(df.sparkSession)
    columns = {f: F.col(f"`{f}`") for f in fields}
    changed = F.lit(None).cast("binary")
    if tampered:
        swapped = {**columns, **tampered}
        changed = F.when(tamper, leaf([swapped[f] for f in fields]))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), group_key(F.col(f"`{group_col}`")).alias("g"),
                     leaf(list(columns.values())).alias("h"), changed.alias("changed"),
                     F.monotonically_increasing_id().alias("row"))
    rows = scratch.stage(rows, "merkle-leaves")
    low = tree(placed(rows, ["id", "h", "row"], scratch).drop("row"), arity, scratch)
    scratch.drop(rows)
    groups = low[-1][1]  # at most: every group's one node
    tops = scratch.stage(few(subroots(low), groups), "merkle-subroots")
    ranked = tops.select(F.lit("").alias("g"), F.col("g").alias("group"), "h")
    high = tree(placed(ranked, ["group"], scratch), arity, scratch)
    root = subroots(high).first()
    nothing = high[0][0].select("g", F.lit(None).cast("binary").alias("subroot"),
                             F.array().cast("array<struct<l:binary,r:binary>>").alias("path")) \
        .limit(1)
    tops = paths(high, nothing, arity, scratch).select(
        F.col("group").alias("g"), F.col("h").alias("subroot"), "path")
    out = paths(low, scratch.stage(few(tops, groups), "merkle-tops"), arity, scratch)
    return (out.select(F.col("id").alias(id_col), F.col("h").alias("leaf"), "changed", "subroot",
                       "path"), root and bytes(root["h"]).hex())


def fold(path: Column, start: Column) -> Column:
    """The root that a leaf and its proof lead to (packed)."""
    return F.aggregate(path, start, lambda at, run: digest_of(
        hex_text(F.concat(run["l"], at, run["r"]))))


def proof_digest(path: Column) -> Column:
    """H of all siblings of a proof, level by level, left to right (hex text)."""
    packed = F.aggregate(path, none(), lambda done, run: F.concat(done, run["l"], run["r"]))
    return F.sha2(hex_text(packed).cast("binary"), 256)


def verification(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 arity: int = ARITY) -> DataFrame:
    """The manifest of ``df`` checked against tampering: where 3 divides the id's CRC-32,
    the text's letters A-Z are lower-cased. doc_id, leaf, subroot, root, proof_sha256,
    folded_root (from the tampered leaf, else the original one), verified."""
    text = F.col(f"`{text_col}`")
    tamper = F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 0
    rows, root = manifest(df, id_col=id_col, arity=arity, tampered={text_col: lower_ascii(text)},
                          tamper=tamper)
    folded = hex_text(fold(F.col("path"), F.coalesce("changed", "leaf")))
    out = rows.select(
        F.col(id_col).alias("doc_id"), hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"), F.lit(root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
