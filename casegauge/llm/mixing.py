"""Mixing overlapping sources to target weights: a min-cost flow over membership patterns.

A document may belong to several sources. Documents are aggregated by membership pattern
(the sorted set of their sources); a flow network then routes each pattern's words to its
sources' quotas -- pattern -> source arcs behind one arc per repetition of the pattern,
each dearer than the one before (convex: nothing is repeated while something unused fits).
Last, documents are chosen by a seeded hash: a pattern's documents lie on a line in hash
order, repetition after repetition, and every source takes the stretch that the flow gave it.

Where a stretch ends is found without sorting a pattern: documents fall into ``BUCKETS``
equal hash ranges, the ranges' word sums (one partial aggregate) tell which range holds an
end, and only documents of such ranges are ordered. A source with a third of all rows costs
what any other costs.

Targets are computed over the table of sources. Patterns that are connected by shared sources
form a group (stars around each source's first pattern, joined up to components), and every
group -- also a single source that overlaps with no other -- has its own network, solved in a
task: any number of groups fits, and only a group of more than ``max_patterns`` patterns, whose
flow can't be found piece by piece, is refused. Nothing but counts reaches the driver.

Defined results: a null text has size 0; documents of size 0 are taken once if their
pattern is taken at their place (0 words either way); a null source is a source of its own,
last in order; a document without sources (empty membership) is never taken; rows that are
equal in id and text share one place on the line; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegauge.llm.common import Scratch, count_words
from casegauge.llm.near_dup import components
from casegauge.operators.joins import broadcast_if_small

BUCKETS = 1024
REPEATS = 2


# ----------------------------------------------------------------------------
# Targets and flow: on totals
# ----------------------------------------------------------------------------

def targets(sizes: dict, weights: dict, share: Fraction = Fraction(3, 2),
            repeats: int = REPEATS) -> dict:
    """Words wanted of each source: ``share`` of all words split by weight; a source stops
    at ``repeats`` times its size and the excess is reshared by weight among the rest,
    until none is above. Exact (fractions)."""
    wanted: dict = {}
    left = share * sum(sizes.values())
    open_ = {s for s in sizes}
    while open_:
        total = sum(weights[s] for s in open_)
        above = {s for s in open_ if left * weights[s] > repeats * sizes[s] * total}
        if not above:
            wanted.update({s: Fraction(left * weights[s], total) for s in open_})
            break
        for s in above:
            wanted[s] = Fraction(repeats * sizes[s])
        left -= sum(wanted[s] for s in above)
        open_ -= above
    return wanted


def min_cost_flow(capacity: Sequence[int], members: Sequence[Sequence[int]],
                  quotas: Sequence[int], repeats: int = REPEATS) -> list[dict[tuple[int, int], int]]:
    """Words of pattern p's k-th repetition that go to each source: ``out[p][k, s]``.

    Successive shortest paths (Dijkstra on reduced costs) over the network
    start -> (pattern, repetition) [capacity, cost 4**k] -> source -> end [quota]. The cost
    grows faster than the repetition, so the flow is the fullest one that repeats least.
    """
    start, n_p, n_s = 0, len(capacity), len(quotas)
    level = [[1 + p * repeats + k for k in range(repeats)] for p in range(n_p)]
    source = [1 + n_p * repeats + s for s in range(n_s)]
    end = 1 + n_p * repeats + n_s
    arcs: list[list] = []  # to, capacity left, cost
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def add(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(arcs))
        arcs.append([b, room, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])
        return len(arcs) - 2

    routes: dict[int, tuple[int, int, int]] = {}
    for p in range(n_p):
        for k in range(repeats):
            add(start, level[p][k], capacity[p], 4 ** k)
            for s in members[p]:
                routes[add(level[p][k], source[s], capacity[p], 0)] = (p, k, s)
    for s in range(n_s):
        add(source[s], end, quotas[s], 0)

    potential = [0] * (end + 1)
    while True:
        far: list[float] = [float("inf")] * (end + 1)
        via = [-1] * (end + 1)
        far[start] = 0
        heap = [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for i in out[a]:
                b, room, cost = arcs[i]
                if room > 0 and (nd := d + cost + potential[a] - potential[b]) < far[b]:
                    far[b], via[b] = nd, i
                    heapq.heappush(heap, (nd, b))
        if via[end] < 0:
            break
        for a in range(end + 1):
            if far[a] < float("inf"):
                potential[a] += far[a]
        push, b = float("inf"), end
        while b != start:
            push = min(push, arcs[via[b]][1])
            b = arcs[via[b] ^ 1][0]
        b = end
        while b != start:
            arcs[via[b]][1] -= push
            arcs[via[b] ^ 1][1] += push
            b = arcs[via[b] ^ 1][0]
    flows: list[dict[tuple[int, int], int]] = [{} for _ in range(n_p)]
    for i, (p, k, s) in routes.items():
        if arcs[i ^ 1][1]:
            flows[p][k, s] = int(arcs[i ^ 1][1])
    return flows


# ----------------------------------------------------------------------------
# Documents
# ----------------------------------------------------------------------------

def _key(source: Column) -> Column:
    """A source's key in patterns: "n" for null, "v" + name otherwise."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), source))


def code_point_order(keys) -> list[str]:
    """Source keys by the code points of their names, null last."""
    return sorted((k for k in keys if k != "n")) + (["n"] if "n" in set(keys) else [])


def placed(df: DataFrame, sources: Column, id_col: str, text_col: str, seed: int,
           carry: tuple[str, ...] = ()) -> DataFrame:
    """pattern (sorted source keys), size (words), place (a seeded 64-bit hash of id and
    text) and bucket (the hash range it falls into) of each document; ``row`` holds the
    columns named in ``carry``, whatever they are called."""
    t, i = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    place = F.xxhash64(F.lit(seed), i, F.xxhash64(t))
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or (id_col,)]).alias("row"),
        F.array_sort(F.array_distinct(F.transform(sources, _key))).alias("pattern"),
        count_words(t).alias("size"), place.alias("place")).withColumn(
        "bucket", F.pmod("place", F.lit(BUCKETS)).cast("int"))


def _stretches(flows: dict[tuple[int, int], int]) -> list[tuple[int, int, int, int]]:
    """(repetition, from, to, source): the stretches of a pattern's line that sources take,
    one after the other, anew in each repetition."""
    out = []
    at = defaultdict(int)
    for (k, s), f in sorted(flows.items()):
        out.append((k, at[k], at[k] + f, s))
        at[k] += f
    return out


def _ranked(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``sources`` with ``rank`` in code-point order, null last: sorted by ranges, numbered
    within them and moved by the rows of the ranges before."""
    rows = scratch.stage(sources.orderBy(F.col("source") == "n", "source")
                         .withColumn("at", F.monotonically_increasing_id()), "mix-sorted")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    before, starts = 0, []
    for r in sorted(rows.groupBy("part").count().collect()):
        starts.append((r["part"], before))
        before += r["count"]
    starts = sources.sparkSession.createDataFrame(starts, "part bigint, before bigint")
    rank = F.col("before") + F.col("at") - F.shiftleft("part", 33)
    return rows.join(F.broadcast(starts), "part").withColumn("rank", rank) \
        .drop("at", "part", "before")


def _whole(c: Column | int) -> Column:
    """An integer of up to 38 digits."""
    return (F.lit(Decimal(c)) if isinstance(c, int) else c).cast("decimal(38,0)")


def targets_table(ranked: DataFrame, cycle: Sequence[int], share: Fraction,
                  repeats: int) -> DataFrame:
    """``targets`` over a table of sources, with weights that repeat along the rank: target,
    and quota (the target rounded, half to even). Each round is one aggregate, exact in
    integers: a source is closed if left / open weights > repeats * size / weight."""
    rows = ranked.withColumn("weight", F.get(F.array(*map(F.lit, cycle)),
                                             (F.col("rank") % len(cycle)).cast("int")))
    size, weight = _whole(F.col("size")), _whole(F.col("weight"))
    words, weights = (int(x or 0) for x in rows.agg(F.sum(size), F.sum(weight)).first())
    n, d = Fraction(share).numerator, Fraction(share).denominator
    left, open_, n_closed = n * words, weights, 0  # d * left
    closed = F.lit(True)
    while open_:
        closed = _whole(left) * weight > _whole(repeats * d * open_) * size
        r = rows.agg(F.count_if(closed), F.sum(F.when(closed, size)),
                     F.sum(F.when(closed, weight))).first()
        if r[0] == n_closed:
            break
        n_closed, closed = r[0], F.lit(True)
        left, open_ = n * words - d * repeats * int(r[1]), weights - int(r[2])
    by, of = _whole(left) * weight, _whole(max(1, d * open_))
    rest = by % of
    down = ((by - rest) / of).cast("bigint")
    up = (2 * rest > of) | ((2 * rest == of) & (down % 2 == 1))
    full = F.lit(repeats) * F.col("size")
    return rows.select(
        "source", "size",
        F.when(closed, full.cast("double")).otherwise(by.cast("double") / of.cast("double"))
        .alias("target"),
        F.when(closed, full).otherwise(down + up.cast("int")).alias("quota"))


def sources_of(totals: DataFrame, weights, share: Fraction, repeats: int,
               scratch: Scratch) -> DataFrame:
    """One row per source: size (words), target and quota. Weights other than ``repeating`` are
    a function of all sources, which therefore go to the driver."""
    sources = totals.select(F.explode("pattern").alias("source"), "n").groupBy("source").agg(
        F.sum("n").alias("size"))
    if isinstance(weights, repeating) and all(isinstance(w, int) for w in weights.cycle):
        ranked = scratch.stage(_ranked(sources, scratch), "mix-ranked")
        return scratch.stage(targets_table(ranked, weights.cycle, share, repeats), "mix-sources")
    rows = {r["source"]: r for r in sources.collect()}
    keys = code_point_order(rows)
    wanted = targets({k: rows[k]["size"] for k in keys}, weights(keys), share, repeats)
    return scratch.stage(totals.sparkSession.createDataFrame(
        [(k, rows[k]["size"], float(wanted[k]), round(wanted[k])) for k in keys],
        "source string, size bigint, target double, quota bigint"), "mix-sources")


def grouped(totals: DataFrame, sources: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per pattern: group, pattern, n (words) and ``quotas`` (its sources with theirs).
    Patterns are of one group if sources connect them."""
    parts = totals.select("pattern", "n", F.explode("pattern").alias("source")) \
        .join(sources.select("source", "quota"), "source")
    rows = scratch.stage(parts.groupBy("pattern", "n").agg(
        F.sort_array(F.collect_list(F.struct("source", "quota"))).alias("quotas")).withColumn(
        "no", F.monotonically_increasing_id()), "mix-patterns")
    held = rows.select("no", F.explode("quotas.source").alias("source"))
    hubs = held.groupBy("source").agg(F.min("no").alias("hub"))
    links = scratch.stage(held.join(hubs, "source").where("no != hub").select(
        F.col("no").alias("a"), F.col("hub").alias("b")), "mix-links")
    group = F.col("no")
    if not links.isEmpty():  # else every pattern stands alone
        found = components(links, scratch)
        rows = rows.join(found, F.col("no") == F.col("id"), "left")
        group = F.coalesce("component", "no")
    return rows.select(group.alias("group"), "pattern", "n", "quotas")


LINE = "array<struct<k:int,from_:bigint,to_:bigint,source:string>>"


def _solve(rows: pd.DataFrame, repeats: int) -> pd.DataFrame:
    """One group's lines: its network's flow as stretches of its patterns."""
    rows = sorted(zip(map(tuple, rows["pattern"]), rows["n"], rows["quotas"]))
    quotas = {x["source"]: int(x["quota"]) for _, _, q in rows for x in q}
    keys = code_point_order(quotas)
    place = {k: i for i, k in enumerate(keys)}
    flows = min_cost_flow([int(n) for _, n, _ in rows], [[place[k] for k in p] for p, _, _ in rows],
                          [quotas[k] for k in keys], repeats)
    return pd.DataFrame({"pattern": [list(p) for p, _, _ in rows], "line": [
        [{"k": k, "from_": a, "to_": b, "source": keys[s]} for k, a, b, s in _stretches(f)]
        for f in flows]})


def lines_of(totals: DataFrame, sources: DataFrame, repeats: int, max_patterns: int,
             scratch: Scratch) -> DataFrame:
    """pattern and line (the stretches that sources take) of every pattern."""
    rows = scratch.stage(grouped(totals, sources, scratch), "mix-groups")
    most = rows.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    if most > max_patterns:
        raise ValueError(f"{most} membership patterns are connected by shared sources, more than "
                         f"max_patterns = {max_patterns}: raise it or merge sources")
    solved = rows.groupBy("group").applyInPandas(lambda r: _solve(r, repeats),
                                                 f"pattern array<string>, line {LINE}")
    return scratch.stage(solved, "mix-lines")


def _taken(line: Column, middle: Column) -> Column:
    """The sources in whose stretches a doubled position lies, one per copy."""
    return F.transform(F.filter(line, lambda x: (2 * x["from_"] <= middle)
                                & (middle < 2 * x["to_"])), lambda x: x["source"])


def mix(docs: DataFrame, weights, share: Fraction = Fraction(3, 2), repeats: int = REPEATS,
        max_patterns: int = 100_000, scratch: Scratch | None = None) -> tuple[DataFrame, dict]:
    """``placed`` documents with ``taken_by``: the source that takes each copy (empty: the
    mix leaves the document out), and the plan, two tables: ``sources`` (source, size, target,
    quota) and ``lines`` (pattern, line: the stretches that the flow gave to sources). A group of
    more than ``max_patterns`` connected patterns is refused.

    A copy goes to the source in whose stretch the document's middle word lies. A hash
    range without the end of a stretch is decided as a whole, by a join with the ranges'
    table (patterns x BUCKETS rows, broadcast if its measured size allows); the documents
    of the few other ranges are ordered within their range, about 1/BUCKETS of a pattern
    each, so only they are shuffled.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    sums = scratch.stage(docs.groupBy("pattern", "bucket").agg(F.sum("size").alias("words")),
                         "mix-sums")
    totals = scratch.stage(sums.groupBy("pattern").agg(F.sum("words").alias("n")), "mix-totals")
    sources = sources_of(totals, weights, share, repeats, scratch)
    lines = lines_of(totals.where(F.size("pattern") > 0), sources, repeats, max_patterns, scratch)
    plan = {"sources": sources, "lines": lines}
    before = F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    after = F.col("before") + F.col("words")
    cut = F.exists("line", lambda x: ((x["from_"] > F.col("before")) & (x["from_"] < after))
                   | ((x["to_"] > F.col("before")) & (x["to_"] < after)))
    ranges = sums.withColumn("before", F.coalesce(before, F.lit(0).cast("bigint"))) \
        .join(lines, "pattern", "left") \
        .withColumn("line", F.coalesce("line", F.array().cast(LINE))).withColumn("cut", cut)
    whole = F.when(~F.col("cut"), _taken(F.col("line"), 2 * F.col("before")))
    ranges = scratch.stage(ranges.select(
        "pattern", "bucket", "before", "cut", whole.alias("whole"),
        F.when(F.col("cut"), F.col("line")).alias("line")), "mix-ranges")
    ranges, _ = broadcast_if_small(ranges, max_bytes=64 << 20)
    decided = docs.join(ranges, ["pattern", "bucket"])
    within = Window.partitionBy("pattern", "bucket").orderBy("place", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0).cast("bigint"))
    ordered = decided.where(F.col("cut")).withColumn("middle", 2 * at + F.col("size"))
    out = [decided.where(~F.col("cut")).select(*docs.columns, F.col("whole").alias("taken_by")),
           ordered.select(*docs.columns, _taken(F.col("line"), F.col("middle")).alias("taken_by"))]
    return out[0].unionByName(out[1]), plan


class repeating:
    """Weights that repeat along the ordered sources: 5, 2, 1, 5, 2, 1, ..."""

    def __init__(self, cycle: Sequence[int]):
        self.cycle = tuple(cycle)

    def __call__(self, keys: Sequence[str]) -> dict:
        return {k: self.cycle[i % len(self.cycle)] for i, k in enumerate(keys)}


def mixture(df: DataFrame, cycle: Sequence[int] = (5, 2, 1), seed: int = 20240229,
            share: Fraction = Fraction(3, 2), id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> DataFrame:
    """The mix of single-source documents, one row each: doc_id, size, source_size, target
    (of its source), taken (words the mix takes, repeats counted) and copies."""
    scratch = Scratch(df.sparkSession)
    docs = scratch.stage(placed(df, F.array(F.col(f"`{source_col}`")), id_col, text_col, seed),
                         "mix-sized")
    chosen, plan = mix(docs, repeating(cycle), share, scratch=scratch)
    facts = plan["sources"].select(F.array("source").alias("pattern"),
                                   F.col("size").alias("source_size"), "target")
    copies = F.size("taken_by")
    return chosen.join(broadcast_if_small(facts)[0], "pattern").select(
        F.col(f"row.`{id_col}`").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies"))


def expand(df: DataFrame, cycle: Sequence[int] = (5, 2, 1), seed: int = 20240229,
           share: Fraction = Fraction(3, 2), id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> DataFrame:
    """The mixed corpus itself: each row of ``df`` as many times as the mix takes it. Texts
    ride along, so only those of cut ranges are shuffled."""
    docs = placed(df, F.array(F.col(f"`{source_col}`")), id_col, text_col, seed,
                  tuple(df.columns))
    chosen, _ = mix(docs, repeating(cycle), share)
    return chosen.select("row", F.explode("taken_by").alias("taken_by")).select("row.*")
