"""LM scoring: cross-entropy difference of two matched n-gram models.

Target and background are character 4-gram models (a text is its code points behind a
start mark), of one order and one smoothing (interpolated Witten-Bell down to a uniform
distribution over the vocabulary), on one shared vocabulary: every code point of the
background corpus, which contains the scored documents, so nothing scored is unknown.
A token's score is the difference of its losses, log p_background - log p_target; a
document's is the mean over its tokens (below 0: more like the target).

Counts cover all texts, whole. Tasks count their own n-grams in numpy and one shuffle adds
them up; the models are then DataFrames keyed by n-gram, and only the difference per
4-gram is carried to the texts: broadcast if its measured size allows; beyond that the
tasks' distinct n-grams are joined by shuffle.

Defined results: null and empty texts have 0 tokens, no cross-entropies (null) and score
0; an empty target makes its model uniform; repeated rows count as often as they stand;
an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegauge.llm.common import Scratch, mix64, text_batches
from casegauge.operators.joins import broadcast_if_small

ORDER = 4
START = 0x10FFFF + 1  # a mark that is no code point
_BITS = 21
# an n-gram: the three code points of its context packed in one long, and its token
GRAM = "ctx bigint, tok int, n_target bigint, n_background bigint"


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context (three code points, packed) and token of every position of the texts, and
    the number of positions of each text."""
    joined = b"\0\0\0" + b"\0\0\0".join(texts)
    points = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.fromiter((len(t.decode()) for t in texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + ORDER - 1)[:-1]])
    for i in range(ORDER - 1):
        points[begins + i] = START
    ctx = np.zeros(max(len(points) - ORDER + 1, 0), np.int64)
    for i in range(ORDER - 1):
        ctx |= points[i:len(ctx) + i] << (_BITS * (ORDER - 2 - i))
    own = np.ones(len(ctx), bool)  # positions whose token is a text's own character
    for i in range(ORDER - 1):
        at = begins[1:] + i - (ORDER - 1)
        own[at[(at >= 0) & (at < len(own))]] = False
    return ctx[own], points[ORDER - 1:][own], sizes


def _hash(ctx: np.ndarray, tok: np.ndarray) -> np.ndarray:
    return mix64(mix64(ctx.astype(np.uint64)) + tok.astype(np.uint64))


def _unique(ctx, tok, weights):
    """Distinct (ctx, tok) with summed weights (one column per model). Sorts one 64-bit hash
    per n-gram; should two n-grams share one, the n-grams themselves are sorted."""
    if not len(ctx):
        return ctx, tok, weights
    h = _hash(ctx, tok)
    order = np.argsort(h)
    h, c, t = h[order], ctx[order], tok[order]
    new = h[1:] != h[:-1]
    if ((c[1:] != c[:-1]) | (t[1:] != t[:-1]) != new).any():
        order = np.lexsort((tok, ctx))
        c, t = ctx[order], tok[order]
        new = (c[1:] != c[:-1]) | (t[1:] != t[:-1])
    at = np.concatenate([[0], np.flatnonzero(new) + 1])
    return c[at], t[at], np.add.reduceat(weights[order], at, axis=0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of a task with their counts: slices are counted one by one and merged
    pairwise by size, so that memory follows the distinct n-grams."""
    held: list[tuple] = []

    def merge(parts):
        return _unique(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
    for part, texts in text_batches(batches, "text", 2 << 20):
        ctx, tok, sizes = grams(texts)
        target = np.asarray(part.column("target").fill_null(False).to_numpy(zero_copy_only=False))
        weights = np.ones((len(ctx), 2), np.int32)
        weights[:, 0] = np.repeat(target, sizes)
        c, t, n = _unique(ctx, tok, weights)
        held.append((c, t, n.astype(np.int64)))
        while len(held) > 1 and len(held[-2][0]) < 2 * len(held[-1][0]):
            held[-2:] = [merge(held[-2:])]
    if held:
        ctx, tok, n = merge(held)
        for i in range(0, len(ctx), 100_000):
            s = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ctx[s]), pa.array(tok[s].astype(np.int32)), pa.array(n[s, 0]),
                 pa.array(n[s, 1])], names=["ctx", "tok", "n_target", "n_background"])


def count_grams(df: DataFrame, text_col: str = "text", target_col: str = "target") -> DataFrame:
    """Counts of every 4-gram of the corpus in target texts and in all texts."""
    texts = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{target_col}`").alias("target"))
    return texts.mapInArrow(_count, GRAM).groupBy("ctx", "tok").agg(
        F.sum("n_target").alias("n_target"), F.sum("n_background").alias("n_background"))


def _level(counts: DataFrame, lower: DataFrame | None, vocabulary: int, keep: int) -> DataFrame:
    """Witten-Bell probabilities of both models for every n-gram of ``keep`` context
    tokens: p(w | c) = (n(c w) + T(c) p(w | shorter c)) / (n(c) + T(c)), T(c) the number of
    distinct tokens after c; where a model hasn't seen c, the shorter context alone."""
    mask = (1 << (_BITS * keep)) - 1
    here = counts.groupBy(F.col("ctx").bitwiseAND(F.lit(mask)).alias("ctx"), "tok").agg(
        F.sum("n_target").alias("n_target"), F.sum("n_background").alias("n_background"))
    names = ("target", "background")
    sums = here.groupBy("ctx").agg(*[x for m in names for x in (
        F.sum(f"n_{m}").alias(f"all_{m}"),
        F.sum((F.col(f"n_{m}") > 0).cast("bigint")).alias(f"kinds_{m}"))])
    joined = here.join(sums, "ctx")
    if lower is None:
        joined = joined.withColumns({f"q_{m}": F.lit(1.0 / vocabulary) for m in names})
    else:
        shorter = (1 << (_BITS * (keep - 1))) - 1
        joined = joined.withColumn("low", F.col("ctx").bitwiseAND(F.lit(shorter))).join(
            lower.select(F.col("ctx").alias("low"), "tok",
                         *[F.col(f"p_{m}").alias(f"q_{m}") for m in names]), ["low", "tok"])
    def smoothed(m: str):
        kinds = F.col(f"kinds_{m}")
        p = (F.col(f"n_{m}") + kinds * F.col(f"q_{m}")) / (F.col(f"all_{m}") + kinds)
        return F.when(kinds > 0, p).otherwise(F.col(f"q_{m}")).alias(f"p_{m}")
    return joined.select("ctx", "tok", *map(smoothed, names))


def train(counts: DataFrame) -> DataFrame:
    """Losses -log p of every 4-gram of the corpus under both models: ctx, tok, loss_target,
    loss_background. Lower orders are aggregates of the 4-gram counts."""
    vocabulary = max(1, counts.select("tok").distinct().count())
    level = None
    for keep in range(ORDER):
        level = _level(counts, level, vocabulary, keep)
    return level.select("ctx", "tok", (-F.log("p_target")).alias("loss_target"),
                        (-F.log("p_background")).alias("loss_background"))


class _Table:
    """The models as arrays for look-up inside tasks: a hash table of row numbers, in which
    the last row of a slot wins; n-grams that lost their slot are found by binary search."""

    def __init__(self, ctx: np.ndarray, tok: np.ndarray, losses: np.ndarray):
        order = np.lexsort((tok, ctx))
        self.ctx, self.tok, self.losses = ctx[order], tok[order].astype(np.int32), losses[order]
        self.shift = np.uint64(64 - max(4, int(len(ctx)).bit_length() + 2))
        self.slots = np.zeros(1 << int(64 - self.shift), np.int32)
        self.slots[self._slot(self.ctx, self.tok)] = np.arange(len(ctx))
        self.contexts, first = np.unique(self.ctx, return_index=True)
        self.keys = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ctx)))) \
            << _BITS | self.tok

    def _slot(self, ctx, tok):
        return (_hash(ctx, tok) >> self.shift).astype(np.int64)

    def __call__(self, ctx: np.ndarray, tok: np.ndarray) -> np.ndarray:
        row = self.slots[self._slot(ctx, tok)]
        lost = np.flatnonzero((self.ctx[row] != ctx) | (self.tok[row] != tok))
        rank = np.searchsorted(self.contexts, ctx[lost])
        row[lost] = np.searchsorted(self.keys, rank << _BITS | tok[lost])
        return self.losses[row]


SCORED = "n_tokens bigint, sum_target double, sum_background double"


def _score(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    model = table.value
    for part, texts in text_batches(batches, "text", 2 << 20):
        ctx, tok, sizes = grams(texts)
        sums = np.zeros((len(texts), 2))
        some = sizes > 0
        if some.any():  # summed text by text, so that slices don't show in the last digits
            begins = (np.cumsum(sizes) - sizes)[some]
            sums[some] = np.add.reduceat(model(ctx, tok), begins, axis=0)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
            names=["doc_id", "n_tokens", "sum_target", "sum_background"])


def _doc_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of each text with their counts (for the joined path)."""
    for part, texts in text_batches(batches, "text", 2 << 20):
        for row, text in enumerate(texts):
            ctx, tok, _ = grams([text])
            if not len(ctx):
                ctx, tok = np.array([-1]), np.array([-1])
            c, t, n = _unique(ctx, tok, np.ones((len(ctx), 1), np.int64))
            one = part.slice(row, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.column("doc_id").to_pylist() * len(c), one.schema.field("doc_id").type),
                 pa.array(one.column("place").to_pylist() * len(c), pa.int64()),
                 pa.array(c), pa.array(t.astype(np.int32)), pa.array(n[:, 0])],
                names=["doc_id", "place", "ctx", "tok", "n"])


def score(df: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = 2_000_000) -> DataFrame:
    """doc_id, n_tokens, the cross-entropies under both models and their difference."""
    spark = df.sparkSession
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    if model.count() <= max_rows:  # 32 bytes a row
        rows = model.toArrow()
        table = spark.sparkContext.broadcast(_Table(
            rows["ctx"].to_numpy(), rows["tok"].to_numpy().astype(np.int64),
            np.stack([rows["loss_target"].to_numpy(), rows["loss_background"].to_numpy()], 1)))
        sums = texts.mapInArrow(lambda b: _score(b, table), f"doc_id {kind}, {SCORED}")
    else:
        placed = texts.withColumn("place", F.monotonically_increasing_id())
        each = placed.mapInArrow(
            _doc_grams, f"doc_id {kind}, place bigint, ctx bigint, tok int, n bigint")
        sums = each.join(model, ["ctx", "tok"], "left").groupBy("doc_id", "place").agg(
            F.sum(F.when(F.col("ctx") >= 0, F.col("n")).otherwise(0)).alias("n_tokens"),
            F.coalesce(F.sum(F.col("n") * F.col("loss_target")), F.lit(0.0)).alias("sum_target"),
            F.coalesce(F.sum(F.col("n") * F.col("loss_background")), F.lit(0.0))
            .alias("sum_background"))
    n = F.when(F.col("n_tokens") > 0, F.col("n_tokens"))
    ce = {m: F.col(f"sum_{m}") / n for m in ("target", "background")}
    return sums.select("doc_id", "n_tokens", ce["target"].alias("ce_target"),
                       ce["background"].alias("ce_background"),
                       F.coalesce(ce["target"] - ce["background"], F.lit(0.0)).alias("score"))


def cross_entropy_difference(df: DataFrame, target: DataFrame, id_col: str = "doc_id",
                             text_col: str = "text") -> DataFrame:
    """Scores of all rows of ``df``; ``target`` (column ``id_col``) names the documents the
    target model learns from. Small target lists are broadcast; others join by shuffle."""
    scratch = Scratch(df.sparkSession)
    ids = scratch.stage(target.select(F.col(f"`{id_col}`").alias("__id")).where("__id is not null")
                        .distinct().withColumn("target", F.lit(True)), "target")
    small, _ = broadcast_if_small(ids)
    texts = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("text"))
    marked = texts.join(small, "__id", "left").select("text", "target")
    counts = scratch.stage(count_grams(marked), "grams")
    model = scratch.stage(train(counts), "model")
    scratch.drop(counts, ids)
    return score(df, model, id_col, text_col)
