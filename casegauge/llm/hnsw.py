"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt into shards of about ``SHARD`` by hash. A shard's graph is a handful of
flat arrays: per level the nodes that stand there, and an array of neighbour numbers, a fixed
number per node (-1: none). As a shard is bounded, a level's candidate neighbours are found
exactly, by blocks of distances, instead of by searching the growing graph; of them each
node keeps a diverse subset (a candidate nearer to a kept neighbour than to the node is
left to fill up), and edges are made mutual as far as there is room. A node's top level is
drawn from its id; besides, every connected piece of a level's graph sends one node up, so that
tight clusters, which link to nothing else, can all be reached from the top.

A search starts from all nodes of the top level (few) and goes down with a beam of ``UPPER``,
whose nodes are the next level's entries, to a beam of ``ef`` on level 0, for a block of queries
at once. Each shard gives its best rows for each query, and a window with a group limit merges
the shards. Graphs are built and searched in double precision, on vectors shifted by their
componentwise median and scaled into range, so neither a common offset nor the magnitude
matters; distances of results are computed on the vectors as given.

Equal vectors are one node that lists the smallest ids among them (as many as a result can
ever show), so a hot group of copies neither fills a shard nor cuts the graph.

Units of work are (shard, block of queries): a unit holds one shard's graph and at most
about ``QUERY_BLOCK`` queries, whatever the table's size.

Defined results: vectors that are null, zero, or hold null or non-finite components take
no part, neither as queries nor as candidates; null ids neither; vectors of different
lengths never meet; a repeated id counts once per distinct vector; a query without
candidates has no rows; an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegauge.llm.common import Scratch, mix64
from casegauge.operators.joins import broadcast_if_small

SHARD = 16384
QUERY_BLOCK = 4096
BLOCK = 256  # nodes whose candidates are found together
LINKS = 16  # per node above level 0; twice as many on level 0, and room for mutual edges
CANDIDATES = 64
EF, UPPER = 160, 32
SEED = 13


# ----------------------------------------------------------------------------
# One shard's graph
# ----------------------------------------------------------------------------

def in_range(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """What a shard's vectors are shifted by (an outlier doesn't move a median), and the power of
    two that brings them to about 1."""
    centre = np.median(vectors, axis=0)
    # halves: the difference of two finite doubles can overflow
    reach = np.abs(vectors / 2 - centre / 2).max(initial=0.0)
    return centre, float(2.0 ** -np.clip(np.frexp(reach)[1] + 1, -1000, 1000)) if reach else 1.0


def moved(vectors: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    return vectors * scale - centre * scale


def _nearest(v: np.ndarray, norms: np.ndarray, lo: int, hi: int, c: int):
    """The ``c`` nearest other nodes of the nodes lo..hi, nearest first, with distances."""
    d = norms[lo:hi, None] + norms - 2 * (v[lo:hi] @ v.T)
    d[np.arange(hi - lo), np.arange(lo, hi)] = np.inf
    part = np.argpartition(d, c - 1, axis=1)[:, :c]
    diff = v[part] - v[lo:hi, None]  # candidates' own distances without cancellation
    exact = np.einsum("ncd,ncd->nc", diff, diff)
    by = np.argsort(exact, axis=1, kind="stable")
    return np.take_along_axis(part, by, 1), np.take_along_axis(exact, by, 1)


def _diverse(v: np.ndarray, order: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Of each node's candidates (nearest first), up to ``links``: those nearer to the node
    than to any neighbour kept before, then the nearest of the others."""
    n, c = order.shape
    x = v[order] - v[order[:, :1]]  # small numbers: shifted to the nearest candidate
    norms = np.einsum("ncd,ncd->nc", x, x)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
    to_kept = np.full((n, c), np.inf)  # of each candidate: distance to the nearest kept one
    taken = np.zeros((n, c), bool)
    count = np.zeros(n, np.int64)
    for j in range(c):
        ok = (near[:, j] < to_kept[:, j]) & (count < links)
        taken[:, j] = ok
        count += ok
        to_kept[ok] = np.minimum(to_kept[ok], between[ok, j])
    # kept ones first, the others as they come
    chosen = np.argsort(~taken, axis=1, kind="stable")[:, :links]
    return np.take_along_axis(order, chosen, 1)


def _mutual(v: np.ndarray, kept: np.ndarray, room: int) -> np.ndarray:
    """A node's own links, then the nearest of those that link to it, up to ``room``."""
    n, links = kept.shape
    a, b = np.repeat(np.arange(n), links), kept.ravel()
    length = np.empty(len(a))
    for lo in range(0, len(a), 1 << 16):
        diff = v[a[lo:lo + (1 << 16)]] - v[b[lo:lo + (1 << 16)]]
        length[lo:lo + (1 << 16)] = np.einsum("nd,nd->n", diff, diff)
    node, other = np.concatenate([a, b]), np.concatenate([b, a])
    back = np.repeat([False, True], len(a))
    order = np.lexsort((np.concatenate([length, length]), back, node))
    node, other = node[order], other[order]
    _, first = np.unique(node * n + other, return_index=True)
    first.sort()
    node, other = node[first], other[first]
    place = np.arange(len(node)) - np.searchsorted(node, np.arange(n))[node]
    out = np.full((n, room), -1, np.int32)
    ok = place < room
    out[node[ok], place[ok]] = other[ok]
    return out


def _pieces(near: np.ndarray) -> np.ndarray:
    """The smallest node of each node's piece: nodes from which a walk along links can't leave.
    Links that lost their way back for want of room count one way only."""
    low = np.arange(len(near))
    while True:
        # a node is led to by ``low`` if a walk from there gets to it
        a, b = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
        a, b = a[b >= 0], b[b >= 0]
        after = low.copy()
        np.minimum.at(after, b, low[a])
        after = after[after]
        if (after == low).all():
            return low
        low = after


def build(vectors: np.ndarray, keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the bottom: (node numbers, neighbour array). Neighbours are node numbers
    of the shard; level 0 holds all nodes. ``keys`` (ids) draw the levels."""
    v = moved(vectors, *in_range(vectors))
    u = ((mix64(keys.astype(np.uint64) + np.uint64(SEED)) >> np.uint64(11)).astype(np.float64)
         + 1) / (1 << 53)
    top = np.floor(-np.log(u) / log(LINKS)).astype(np.int64)
    levels, nodes = [], np.arange(len(v))
    while True:
        n, links = len(nodes), LINKS if levels else 2 * LINKS
        here = v[nodes]
        norms = np.einsum("nd,nd->n", here, here)
        c = min(CANDIDATES, n - 1)
        kept = np.empty((n, min(links, c)), np.int64)
        for lo in range(0, n if c else 0, BLOCK):
            hi = min(lo + BLOCK, n)
            kept[lo:hi] = _diverse(here, *_nearest(here, norms, lo, hi, c), kept.shape[1])
        near = _mutual(here, kept, links + links // 2)
        levels.append((nodes, np.where(near >= 0, nodes[np.maximum(near, 0)], -1).astype(np.int32)))
        if n <= LINKS:
            return levels
        up = top[nodes] >= len(levels)
        low = _pieces(near)
        up[np.setdiff1d(low, low[up])] = True
        if up.all():
            return levels
        nodes = nodes[up]


def _distances(q: np.ndarray, v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own row of nodes (-1: infinite)."""
    diff = v[np.maximum(at, 0)] - q[:, None, :]
    d = np.einsum("qnd,qnd->qn", diff, diff)
    return np.where(at >= 0, d, np.inf)


def _beam(v: np.ndarray, q: np.ndarray, near: np.ndarray, where: np.ndarray, entries: np.ndarray,
          ef: int, width: int = 4) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``ef`` nearest nodes of a level that the walk from each query's entries found, their
    distances, and how many were looked at in all. ``where``: a node's row of ``near``."""
    e = entries.shape[1]
    size = max(ef, e)
    found = np.full((len(q), size), -1, np.int64)
    dist = np.full((len(q), size), np.inf)
    found[:, :e], dist[:, :e] = entries, _distances(q, v, entries)
    opened = found < 0  # nothing to expand there
    seen = np.zeros((len(q), len(near)), bool)
    a, b = np.nonzero(entries >= 0)
    seen[a, where[entries[a, b]]] = True
    looked, go = len(a), np.arange(len(q))
    while len(go):
        waiting = np.where(opened[go], np.inf, dist[go])
        pick = np.argpartition(waiting, min(width, size - 1), axis=1)[:, :width]
        ready = np.take_along_axis(waiting, pick, 1) < np.inf
        some = ready.any(1)
        go, pick, ready = go[some], pick[some], ready[some]
        if not len(go):
            break
        line = np.arange(len(go))[:, None]
        opened[go[:, None], pick] = True
        source = np.where(ready, found[go[:, None], pick], -1)
        around = np.where(source[:, :, None] >= 0, near[where[np.maximum(source, 0)]], -1) \
            .reshape(len(go), -1).astype(np.int64)
        around = np.sort(around, axis=1)
        new = around >= 0
        new[:, 1:] &= around[:, 1:] != around[:, :-1]
        new &= ~seen[go[:, None], where[np.maximum(around, 0)]]
        a, b = np.nonzero(new)
        seen[go[a], where[around[a, b]]] = True
        looked += len(a)
        fresh = np.where(new, around, -1)
        most = max(1, int(new.sum(1).max()))
        fresh = np.take_along_axis(fresh, np.argsort(~new, axis=1, kind="stable")[:, :most], 1)
        d = _distances(q[go], v, fresh)
        all_d = np.concatenate([dist[go], d], 1)
        all_f = np.concatenate([found[go], fresh], 1)
        all_o = np.concatenate([opened[go], fresh < 0], 1)
        keep = np.argpartition(all_d, size - 1, axis=1)[:, :size]
        dist[go], found[go], opened[go] = all_d[line, keep], all_f[line, keep], all_o[line, keep]
    order = np.argsort(dist, axis=1, kind="stable")[:, :ef]
    return np.take_along_axis(found, order, 1), np.take_along_axis(dist, order, 1), looked


def search(vectors: np.ndarray, levels, queries: np.ndarray, ef: int):
    """For each query the ``ef`` nearest nodes that the walk found (number, squared distance
    in the shard's scale), nearest first, -1 where there are fewer; and the nodes looked at."""
    centre, scale = in_range(vectors)
    v = moved(vectors, centre, scale)
    with np.errstate(over="ignore"):  # a query beyond all range is as far from every node
        q = np.clip(moved(queries, centre, scale), -1e150, 1e150)
    entries = np.repeat(levels[-1][0][None, :], len(q), 0).astype(np.int64)
    looked = 0
    for nodes, near in reversed(levels):
        where = np.zeros(len(v), np.int64)
        where[nodes] = np.arange(len(nodes))
        last = near is levels[0][1]
        entries, dist, n = _beam(v, q, near, where, entries, ef if last else UPPER)
        looked += n
    return entries, dist, looked


# ----------------------------------------------------------------------------
# Shards as rows
# ----------------------------------------------------------------------------

INDEX = ("dim int, shard int, ids binary, vectors binary, members binary, nodes array<binary>, "
         "links array<binary>")


def _build_shard(rows: pd.DataFrame, slots: int) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", kind="stable")
    vectors = np.array(rows["vec"].tolist(), np.float64)
    members = np.full((len(rows), slots), np.iinfo(np.int64).min, np.int64)
    for i, m in enumerate(rows["members"]):
        members[i, :len(m)] = m
    ids = rows["vec_id"].to_numpy(np.int64)
    levels = build(vectors, ids)
    return pd.DataFrame([{
        "dim": int(rows["dim"].iloc[0]), "shard": int(rows["shard"].iloc[0]),
        "ids": ids.tobytes(), "vectors": vectors.tobytes(), "members": members.tobytes(),
        "nodes": [x.astype(np.int32).tobytes() for x, _ in levels],
        "links": [x.tobytes() for _, x in levels]}])


def _search_unit(index: pd.DataFrame, asked: pd.DataFrame, k: int, ef: int) -> pd.DataFrame:
    empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64),
                          "score": np.empty(0)})
    if not len(index) or not len(asked):
        return empty
    row = index.iloc[0]
    dim = int(row["dim"])
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
    members = np.frombuffer(row["members"], np.int64).reshape(len(vectors), -1)
    levels = []
    for nodes, links in zip(row["nodes"], row["links"]):
        nodes = np.frombuffer(nodes, np.int32)
        levels.append((nodes, np.frombuffer(links, np.int32).reshape(len(nodes), -1)))
    out = [empty]
    for at in range(0, len(asked), 512):
        part = asked.iloc[at:at + 512]
        queries = np.array(part["vec"].tolist(), np.float64)
        ids = part["query_id"].to_numpy(np.int64)
        found = search(vectors, levels, queries, max(ef, k + 6))[0]
        found = found[:, :k + 6]
        exact = np.sqrt(((vectors[np.maximum(found, 0)] - queries[:, None, :]) ** 2).sum(2))
        each = members[np.maximum(found, 0)]
        good = (found >= 0)[:, :, None] & (each != np.iinfo(np.int64).min) \
            & (each != ids[:, None, None])
        q, c, m = np.nonzero(good)
        rows = pd.DataFrame({"query_id": ids[q], "vec_id": each[q, c, m], "score": exact[q, c]})
        # of copies of an id in several classes the nearest counts
        rows = rows.sort_values(["query_id", "score", "vec_id"], kind="stable") \
            .drop_duplicates(["query_id", "vec_id"])
        out.append(rows[rows.groupby("query_id").cumcount() < k])
    return pd.concat(out, ignore_index=True)


# ----------------------------------------------------------------------------
# The operator
# ----------------------------------------------------------------------------

def usable(vec: Column) -> Column:
    """Not null, not zero, all components finite."""
    value = F.exists(vec, lambda x: x != 0)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(~bad, F.lit(False)) \
        & F.coalesce(value, F.lit(False))


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
                     F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    rows = rows.where("vec_id is not null").where(usable(F.col("vec")))
    # -0.0 and 0.0 are one value
    return rows.select("vec_id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"),
                       F.size("vec").alias("dim"))


def classes(vectors: DataFrame, slots: int) -> DataFrame:
    """One row per distinct vector: its smallest id and its ``slots`` smallest ids. The group
    limit runs before the shuffle, so a hot vector ships a few rows per task."""
    w = Window.partitionBy("vec").orderBy("vec_id")
    return vectors.distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= slots) \
        .groupBy("vec", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("members")) \
        .withColumn("vec_id", F.get("members", F.lit(0)))


def index(df: DataFrame, k: int = 10, shard: int = SHARD, id_col: str = "vec_id",
          vec_col: str = "embedding", scratch: Scratch | None = None) -> DataFrame:
    """The graphs of all shards, one row each (written to the shared folder)."""
    scratch = scratch or Scratch(df.sparkSession)
    nodes = scratch.stage(classes(_vectors(df, id_col, vec_col), k + 1), "hnsw-classes")
    sizes = scratch.stage(nodes.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("n")), "hnsw-sizes")
    dealt = nodes.join(broadcast_if_small(sizes)[0], "dim").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), "n").cast("int")).drop("n")
    built = dealt.groupBy("dim", "shard").applyInPandas(
        lambda rows: _build_shard(rows, k + 1), INDEX)
    out = scratch.stage(built, "hnsw-index")
    scratch.drop(nodes)
    return out


def nearest(df: DataFrame, queries: DataFrame, k: int = 10, ef: int = EF, shard: int = SHARD,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance): the ``k`` nearest rows of
    ``df`` found for each row of ``queries`` (same columns), a query's own id left out; ties
    go to the smaller id."""
    scratch = Scratch(df.sparkSession)
    graphs = index(df, k, shard, id_col, vec_col, scratch)
    asked = _vectors(queries, id_col, vec_col).withColumnRenamed("vec_id", "query_id")
    # shards and blocks per vector length: a few numbers each, from counts
    plan = graphs.groupBy("dim").agg(F.max("shard").alias("last")).join(
        asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("parts")),
        "dim")
    plan = scratch.stage(plan, "hnsw-plan")
    small, _ = broadcast_if_small(plan)
    asked = asked.join(small, "dim").select(
        "dim", "query_id", "vec",
        F.pmod(F.xxhash64("query_id"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("shard"))
    units = graphs.join(small.drop("last"), "dim").select(
        *graphs.columns, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    found = units.groupBy("dim", "shard", "part").cogroup(
        asked.groupBy("dim", "shard", "part")).applyInPandas(
        lambda a, b: _search_unit(a, b, k, ef), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
