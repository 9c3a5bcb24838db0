"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact check.

Documents are sets of word shingles; two are linked when 100 * |A n B| >= 80 * |A u B|.

1. One pass over the texts gives each document's set size, a 128-bit digest of its word
   sequence, a MinHash signature (``HASHES`` values) and a key per band (``ROWS`` values).
   Two documents at the threshold share a band but for (1 - 0.8**5)**32 = 3e-6.
2. Copies (equal digests) become one class, represented by its smallest id.
3. *Stars*: in every band bucket each representative meets the bucket's smallest id -- at
   most one pair per bucket row, however large the bucket is.
4. A pair's signatures are compared batch by batch; after each batch the posterior
   probability that the similarity reaches the threshold (uniform prior, so a Beta
   distribution) is known from the matches so far, and pairs under ``miss`` are dropped.
5. Survivors are verified on the full shingle sets; verified links are joined up to
   components (large-star / small-star, joins only).
6. *Rest*: buckets in which documents of different components still stand side by side
   unseen by each other are compared in blocks: everything outside the bucket's largest
   component against the bucket, ``BLOCK`` rows and ``BLOCK_BYTES`` of sets a side. A pair is
   tested in the first band that it shares only, with the same posterior test, batch by batch
   for all pairs of a block, and then on the full sets, by products of 0/1 matrices. A
   block emits no pairs but the few links that join components. So every
   candidate pair is either tested or already connected, and no link between components
   is missed but by the bands and ``miss``.

Nothing is collected on the driver but row counts. Shuffled are band keys (16 bytes),
signatures of candidates and sets of survivors; texts are never shuffled unless the ids
of survivors exceed the size bound of a broadcast.

Defined results: a null text, or one without words, has the empty set and is linked with
nothing; with fewer words than a shingle the whole sequence is the one shingle; ids stand
for documents, so rows that repeat an id share one component; a null id takes no part
(null component, kept); an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegauge.llm.common import Scratch, few, mix64, powers, text_batches, word_hashes
from casegauge.operators.joins import broadcast_if_small

ROWS, BANDS = 5, 32
HASHES = ROWS * BANDS
BATCH = 32  # signature values compared between two looks at the posterior
BLOCK = 512  # documents of a block's side
BLOCK_BYTES = 16 << 20  # of their sets
PAIRS, MEMBERS, FEW = 1 << 17, 1 << 12, 32
MISS = 1e-6
_U = np.uint64


@lru_cache(maxsize=1)
def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    return (rng.integers(0, 1 << 32, HASHES, dtype=np.uint32),
            rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1))


# ----------------------------------------------------------------------------
# Sets and signatures
# ----------------------------------------------------------------------------

def shingle_sets(texts: list[bytes], k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct k-word shingles, and a 128-bit digest
    of each word sequence (two columns)."""
    h, at = word_hashes(texts)
    counts = np.diff(at)
    multipliers = [_U(mix64(np.array([i + 1], np.uint64))[0] | _U(1)) for i in range(k)]
    if len(h) >= k:
        flat = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            flat += h[i:len(h) - k + 1 + i] * multipliers[i]
        flat = mix64(flat)
    sets, digests = [], np.zeros((len(texts), 2), np.uint64)
    for d in range(len(texts)):
        a, b, n = at[d], at[d + 1], counts[d]
        if n == 0:
            sets.append(np.empty(0, np.uint64))
            continue
        w = h[a:b]
        digests[d, 0] = (w * powers(0xD6E8FEB86659FD93, n)).sum() + _U(n)
        digests[d, 1] = (mix64(w) * powers(0xA24BAED4963EE407, n)).sum()
        if n >= k:
            sets.append(np.unique(flat[a:b - k + 1]))
        else:
            sets.append(mix64(digests[d, :1] ^ _U(0x5851F42D4C957F2D)))
    return sets, mix64(digests)


def signature(s: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of a set, in pieces that fit the cache."""
    xor, times = _seeds()
    x = (s >> _U(32)).astype(np.uint32)
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(out, ((x[None, i:i + 1024] ^ xor[:, None]) * times[:, None]).min(1), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key per band of each signature."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = mix64(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.astype(np.int64)


SIGNED = ("doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary, "
          "keys array<bigint>")


def _sign(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for part, texts in text_batches(batches, "text", 1 << 20):
        sets, digests = shingle_sets(texts, k)
        sigs = np.array([signature(s) for s in sets], np.uint32).reshape(len(sets), HASHES)
        keys = band_keys(sigs)
        some = np.fromiter((len(s) > 0 for s in sets), bool, len(sets))
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id"),
            pa.array(np.fromiter(map(len, sets), np.int64, len(sets))),
            pa.array(digests[:, 0].astype(np.int64)), pa.array(digests[:, 1].astype(np.int64)),
            pa.array([g.tobytes() if x else None for g, x in zip(sigs, some)], pa.binary()),
            pa.array([list(r) if x else None for r, x in zip(keys, some)],
                     pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "d1", "d2", "sig", "keys"])


def signed(df: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    texts = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").alias("text"))
    return texts.mapInArrow(lambda b: _sign(b, k), SIGNED)


def sets_of(df: DataFrame, ids: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``members`` (its shingle hashes, sorted, packed) of the documents in
    ``ids``. The ids are broadcast if their measured size allows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text", 1 << 20):
            sets, _ = shingle_sets(texts, k)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["id", "members"])
    texts = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                      F.col(f"`{text_col}`").alias("text"))
    small, _ = broadcast_if_small(ids)
    return texts.join(small, "id", "left_semi").mapInArrow(run, "id bigint, members binary")


# ----------------------------------------------------------------------------
# Verification
# ----------------------------------------------------------------------------

@lru_cache(maxsize=8)
def least_matches(percent: int, miss: float) -> tuple[int, ...]:
    """Matches that a pair needs after each batch to stay in: fewer, and the posterior
    probability of a similarity of at least ``percent`` is below ``miss``. With a uniform
    prior, m matches of n give Beta(m+1, n-m+1), whose upper tail at x is the
    probability of at most m successes in n+1 trials at x."""
    x = percent / 100

    def tail(m: int, n: int) -> float:
        return sum(comb(n + 1, i) * x ** i * (1 - x) ** (n + 1 - i) for i in range(m + 1))
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        out.append(next(m for m in range(n + 1) if tail(m, n) >= miss))
    return tuple(out)


def plausible(a: np.ndarray, b: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which pairs of signatures (row by row) pass the posterior test of every batch."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for i, m in enumerate(least):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(1)
        alive = alive[matches[alive] >= m]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted shingle sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def plausible_pairs(sigs: np.ndarray, i: np.ndarray, j: np.ndarray,
                    least: tuple[int, ...]) -> np.ndarray:
    """The same for pairs of rows (i, j) of one table; only a batch's values are gathered,
    for ``PAIRS`` pairs at a time."""
    out = []
    for lo in range(0, len(i), PAIRS):
        a, b = i[lo:lo + PAIRS], j[lo:lo + PAIRS]
        alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
        for k, m in enumerate(least):
            part = np.ascontiguousarray(sigs[:, k * BATCH:(k + 1) * BATCH])
            matches += (part[a[alive]] == part[b[alive]]).sum(1)
            keep = matches >= m
            alive, matches = alive[keep], matches[keep]
        out.append(lo + alive)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of the row sets with the column sets: products of 0/1
    matrices over the members that stand on both sides, ``MEMBERS`` of them at a time."""
    def flat(which):
        sizes = [len(sets[i]) for i in which]
        return np.concatenate([sets[i] for i in which]), np.repeat(np.arange(len(which)), sizes)
    (x, x_row), (y, y_row) = flat(rows), flat(columns)
    both = np.intersect1d(x, y)
    out = np.zeros((len(rows), len(columns)), np.float32)

    def placed(values, row):
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        ok = both[at] == values
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], row[ok][order]
    if not len(both):
        return out
    (x, x_row), (y, y_row) = placed(x, x_row), placed(y, y_row)
    for lo in range(0, len(both), MEMBERS):
        sides = []
        for at, row, n in ((x, x_row, len(rows)), (y, y_row, len(columns))):
            a, b = np.searchsorted(at, [lo, lo + MEMBERS])
            side = np.zeros((n, min(MEMBERS, len(both) - lo)), np.float32)
            side[row[a:b], at[a:b] - lo] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T  # at most 2^24 members: exact
    return out


def linked_pairs(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray,
                 percent: int) -> np.ndarray:
    """Which pairs of sets (i, j) pass the exact test, all of a block at once."""
    if len(i) <= FEW:
        return np.array([linked(sets[a], sets[b], percent) for a, b in zip(i, j)], bool)
    rows, row = np.unique(i, return_inverse=True)
    columns, column = np.unique(j, return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    both = common(sets, rows, columns)[row, column].astype(np.int64)
    return 100 * both >= percent * (sizes[i] + sizes[j] - both)


def _filter_pairs(batches: Iterator[pa.RecordBatch], least) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32)
                .reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
        keep = pa.array(plausible(a, b, least))
        yield batch.select(["a", "b"]).filter(keep)


def _verify_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("members_a"), batch.column("members_b")
        keep = [linked(np.frombuffer(x.as_buffer(), np.uint64),
                       np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(a, b)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the values of both ends."""
    a = values.select(F.col("id").alias("a"), F.col(column).alias(f"{column}_a"))
    b = values.select(F.col("id").alias("b"), F.col(column).alias(f"{column}_b"))
    return pairs.join(a, "a").join(b, "b")


# ----------------------------------------------------------------------------
# Components
# ----------------------------------------------------------------------------

def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """id -> component (smallest id reachable) for all ends of ``edges`` (a, b), by
    alternating large-star and small-star steps until the edges no longer change. A star's
    centre is found by a grouped minimum, staged and joined back, so no group is gathered and
    a hot centre's rows can be split."""
    now = scratch.stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u > v").distinct(), "cc")
    state = None
    while True:
        most = 2 * (state[0] if state else now.count())  # a step doubles the edges at most

        def stage(df: DataFrame, purpose: str) -> DataFrame:
            return scratch.stage(few(df, most), purpose)
        # large star: neighbours above u go to the smallest of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = stage(least.select("u", F.least("u", "m").alias("m")), "cc-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v"))
        large = stage(large.where("u > v").distinct(), "cc-large")
        # small star: u and its smaller neighbours go to the smallest of them
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
        after = stage(small.where("u > v").distinct(), "cc")
        sums = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                         ).first()
        scratch.drop(now, least, large, low)
        now = after
        if tuple(sums) == state:
            break
        state = tuple(sums)
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))


# ----------------------------------------------------------------------------
# The rest: buckets with unseen pairs of different components, in blocks
# ----------------------------------------------------------------------------

def _groups(batches: Iterator[pa.RecordBatch]):
    """Runs of equal (key, c, d) of sorted batches, as lists of column arrays."""
    held: list[pa.RecordBatch] = []
    last = None

    def joined():
        t = pa.Table.from_batches(held)
        return {c: t.column(c).to_pylist() for c in t.column_names}
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [np.asarray(batch.column(c)) for c in ("key", "c", "d")]
        change = np.zeros(batch.num_rows, bool)
        for x in names:
            change[1:] |= x[1:] != x[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:]):
            mark = tuple(int(x[a]) for x in names)
            if held and mark != last:
                yield joined()
                held.clear()
            held.append(batch.slice(a, b - a))
            last = mark
    if held:
        yield joined()


def candidates(g: dict, sigs: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a block that this bucket has to test: rest against all, of different
    components and fitting sizes, in the first band that the two share, once."""
    is_rest = np.array(g["rest"], bool)
    rest, full = np.flatnonzero(is_rest), np.flatnonzero(~is_rest)
    keys = band_keys(sigs)
    band = int((keys[0] == g["key"][0]).argmax())
    labels, ids = np.array(g["label"]), np.array(g["id"])
    sizes, main = np.array([len(m) // 8 for m in g["members"]]), np.array(g["main"], bool)
    open_ = labels[rest][:, None] != labels[full]
    for b in range(band):
        open_ &= keys[rest, b][:, None] != keys[full, b]
    a, c = sizes[rest][:, None], sizes[full]
    open_ &= 100 * np.minimum(a, c) >= percent * np.maximum(a, c)
    # two documents of the rest meet as (one, other) and as (other, one)
    open_ &= main[full] | (ids[rest][:, None] < ids[full])
    i, j = np.nonzero(open_)
    return rest[i], full[j]


def _compare_blocks(batches: Iterator[pa.RecordBatch], percent: int, least):
    """Links that join components within each block: documents of the rest (``rest``)
    against all of the bucket's documents in the block."""
    for g in _groups(batches):
        if all(g["rest"]) or not any(g["rest"]):
            continue
        sigs = np.frombuffer(b"".join(g["sig"]), np.uint32).reshape(-1, HASHES)
        i, j = candidates(g, sigs, percent)
        keep = plausible_pairs(sigs, i, j, least)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        sets = [np.frombuffer(m, np.uint64) for m in g["members"]]
        keep = linked_pairs(sets, i, j, percent)
        group = dict()  # local union of components: label -> root

        def root(x):
            while group.get(x, x) != x:
                x = group[x]
            return x
        ids, labels = g["id"], g["label"]
        links: list[tuple[int, int]] = []
        for a, b in zip(i[keep].tolist(), j[keep].tolist()):
            x, y = root(labels[a]), root(labels[b])
            if x != y:
                group[x] = y
                links.append((ids[a], ids[b]))
        if links:
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in links], pa.int64()),
                 pa.array([b for _, b in links], pa.int64())], names=["a", "b"])


def _blocks(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (key, id, label, n_shingles) of buckets dealt into blocks (c: part of the bucket,
    d: part of its rest): a bucket's document stands once in each rest part's row of blocks, a
    document of the rest also once in each part's column. A block's side holds about
    ``BLOCK`` documents and ``BLOCK_BYTES`` of sets, a larger set alone."""
    weight = F.greatest(F.lit(1 / BLOCK), F.col("n_shingles") * 8 / BLOCK_BYTES)
    per_label = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum(weight).alias("w"))
    per_key = per_label.groupBy("key").agg(
        F.sum("n").alias("n_all"), F.sum("w").alias("w_all"),
        F.max(F.struct("n", "label", "w")).alias("top"))
    per_key = scratch.stage(per_key.where("top.n < n_all").select(
        F.col("key"), F.col("top.label").alias("main"),
        F.ceil("w_all").cast("int").alias("n_c"),
        F.greatest(F.ceil(F.col("w_all") - F.col("top.w")), F.lit(1)).cast("int").alias("n_d")),
        "per-key")
    placed = _by_key(rows, per_key).withColumn("h", F.xxhash64("id")).withColumn(
        "main", F.col("label") == F.col("main"))
    full = placed.select("key", "id", "label", "main", F.lit(False).alias("rest"),
                         F.pmod("h", "n_c").cast("int").alias("c"),
                         F.explode(F.sequence(F.lit(0), F.col("n_d") - 1)).alias("d"))
    rest = placed.where("not main").select(
        "key", "id", "label", "main", F.lit(True).alias("rest"),
        F.explode(F.sequence(F.lit(0), F.col("n_c") - 1)).alias("c"),
        F.pmod("h", "n_d").cast("int").alias("d"))
    return full.unionByName(rest)


# ----------------------------------------------------------------------------
# The operator
# ----------------------------------------------------------------------------

def near_duplicates(df: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS,
                    id_col: str = "doc_id", text_col: str = "text",
                    scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept, one
    row per row of ``df``."""
    scratch = scratch or Scratch(df.sparkSession)
    least = least_matches(percent, miss)
    docs = scratch.stage(signed(df, k, id_col, text_col), "sig")
    real = docs.where("doc_id is not null and sig is not null")

    copies = scratch.stage(
        real.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("d1", "d2", "rep"), "copies")
    small, _ = broadcast_if_small(copies)
    classes = real.join(small, ["d1", "d2"], "left") \
        .withColumn("rep", F.coalesce("rep", "doc_id"))
    reps = scratch.stage(classes.where("doc_id = rep")
                         .select(F.col("doc_id").alias("id"), "n_shingles", "sig", "keys"), "reps")
    copy_links = classes.where("doc_id > rep").select(F.col("doc_id").alias("a"),
                                                      F.col("rep").alias("b"))

    bands = reps.select("id", "n_shingles", F.explode("keys").alias("key"))
    hubs = scratch.stage(bands.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top"))
                         .where("hub < top").select("key", "hub"), "hubs")
    buckets = scratch.stage(_by_key(bands, hubs), "buckets")
    stars = buckets.where("id > hub").select(F.col("id").alias("a"), F.col("hub").alias("b")) \
        .distinct()
    signatures = reps.select("id", "sig")
    likely = scratch.stage(
        _both(stars, signatures, "sig").select("a", "b", "sig_a", "sig_b")
        .mapInArrow(lambda x: _filter_pairs(x, least), "a bigint, b bigint"), "likely")
    ids = scratch.stage(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = scratch.stage(sets_of(df, ids, k, id_col, text_col), "sets")
    links = scratch.stage(
        _both(likely, sets, "members").select("a", "b", "members_a", "members_b")
        .mapInArrow(lambda x: _verify_pairs(x, percent), "a bigint, b bigint"), "links")
    scratch.drop(sets, ids, likely)
    first = components(links, scratch)

    labelled = buckets.join(first, "id", "left") \
        .select("key", "hub", "id", "n_shingles", F.coalesce("component", "id").alias("label"))
    rest = scratch.stage(_unseen(labelled, scratch), "rest")
    ids = scratch.stage(rest.select("id").distinct(), "ids")
    sets = scratch.stage(sets_of(df, ids, k, id_col, text_col), "sets")
    full = reps.select("id", "sig").join(sets, "id")
    blocks = _blocks(rest, scratch).join(full, "id").repartition("key", "c", "d") \
        .sortWithinPartitions("key", "c", "d") \
        .select("key", "c", "d", "id", "label", "main", "rest", "sig", "members")
    more = scratch.stage(blocks.mapInArrow(
        lambda x: _compare_blocks(x, percent, least), "a bigint, b bigint"), "links")
    scratch.drop(sets, ids, rest)
    everything = links.unionByName(more).unionByName(copy_links)
    final = components(everything, scratch)
    scratch.drop(hubs, buckets, links, more, reps)
    out = docs.select("doc_id", "n_shingles").join(
        final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _by_key(rows: DataFrame, per_key: DataFrame) -> DataFrame:
    """Rows of buckets with the row of their key. ``per_key`` is staged, not aggregated on
    the way, so that a hot key's rows needn't meet in one task: the planner broadcasts a small
    table, and a shuffle join of two plain exchanges can be split."""
    return rows.join(per_key, "key")


def _unseen(labelled: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of buckets that hold documents of different components which haven't met: a
    bucket's documents have all met its hub, so that the others must differ."""
    others = scratch.stage(
        labelled.where("id != hub").groupBy("key").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
        .select("key"), "unseen")
    return _by_key(labelled.where("id != hub"), others).select("key", "id", "n_shingles", "label")


def keep_one(df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``df`` (all columns) that stay: of every component the document with
    the smallest id, and every document that is linked with nothing."""
    found = near_duplicates(df, k, percent, id_col=id_col, text_col=text_col)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    scratch = Scratch(df.sparkSession)
    gone, _ = broadcast_if_small(scratch.stage(gone, "gone"))
    return df.join(gone, F.col(f"`{id_col}`") == F.col("__gone"), "left_anti")
