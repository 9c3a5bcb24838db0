"""Vector code compression: exact product codes by limb-split matrix products.

A component x becomes the integer floor(4096 * x); a vector is cut into ``PARTS`` consecutive
parts, and every part position has a codebook of up to ``ENTRIES`` integer entries, which
``ROUNDS`` rounds of assignment and componentwise floor(sum / count) refine.

Nearest entries are found by |c|^2 - 2 x.c, exactly: integers are broken into limbs of
``limb_bits`` bits (as many as the largest needs), so narrow that a float64 matrix product
of two limbs stays below 2^53, whatever order BLAS adds in. The products are recombined in
int64 and the first smallest wins; where int64 can't hold them (components beyond about 2^29),
they stay as carried limbs, compared from the highest down. Sums of a round are sums of
limbs too, in int64, put together as integers of any length.

Each round is one pass over the packed integers (written once): a task adds its parts up per
(part, entry), Spark adds up the tasks, and only the codebooks -- PARTS * ENTRIES rows,
bounded by the parameters -- pass through the driver. Which tasks hold which rows changes no
sum, so reruns agree. ``label_error`` is a grouped sum joined back: broadcast if its measured size
allows, else by shuffle, where a hot label's rows can be split.

Defined results: vectors that are null or hold null or non-finite components (also 4096 * x
beyond the doubles) are dropped; so are vectors whose length isn't that of the first kept one
(smallest id), since no code compares them; lengths that the parts don't divide are filled up
with zeros. The first entries are the smallest ids' vectors, ties by components, null ids last;
fewer rows than entries give smaller codebooks; repeated rows are coded one by one; an empty
table gives an empty result. An error, or a label's sum, beyond 64 bits is null. Extra columns take
no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.llm.common import Scratch
from casegauge.operators.joins import broadcast_if_small

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
SLICE = 1 << 14  # vectors that are multiplied at once


# ----------------------------------------------------------------------------
# Exact arithmetic on limbs
# ----------------------------------------------------------------------------

def limb_bits(width: int) -> int:
    """Bits of a limb such that ``width`` products of two add up to less than 2^53."""
    return (53 - max(width, 1).bit_length()) // 2


def limbs_needed(largest: int, bits: int) -> int:
    """Limbs for integers of at most ``largest`` in absolute value: all but the highest are
    unsigned, the highest is signed and no wider than the others."""
    return max(1, -(-(largest.bit_length() + 1) // bits))


def split(values: np.ndarray, bits: int, limbs: int) -> np.ndarray:
    """Limbs (lowest first, on a new first axis) of integers held as doubles; every step is
    exact, as it only moves bits that a double holds."""
    out = np.empty((limbs, *values.shape))
    rest = values.astype(np.float64)
    for k in range(limbs - 1):
        high = np.floor(rest * 2.0 ** -bits)
        out[k] = rest - high * 2.0 ** bits
        rest = high
    out[-1] = rest
    return out


def split_exact(values: list[list[int]], bits: int, limbs: int) -> np.ndarray:
    """The same for integers of any length."""
    mask = (1 << bits) - 1
    out = np.empty((limbs, len(values), len(values[0]) if values else 0))
    for r, row in enumerate(values):
        for c, v in enumerate(row):
            for k in range(limbs - 1):
                out[k, r, c] = v & mask
                v >>= bits
            out[-1, r, c] = v
    return out


class Codebook:
    """One part's entries, with what ``nearest`` needs."""

    def __init__(self, entries: list[list[int]], bits: int, limbs: int):
        self.entries, self.bits, self.limbs = entries, bits, limbs
        self.parts = split_exact(entries, bits, limbs)
        norms = [sum(v * v for v in e) for e in entries]
        self.largest = largest = max([abs(v) for e in entries for v in e], default=0)
        width = len(entries[0]) if entries else 0
        # |score| <= |c|^2 + 2 |x||c| with x as large as the limbs allow
        reach = max(norms, default=0) + 2 * width * largest * (1 << bits * limbs)
        self.narrow = reach < 1 << 62
        self.digits = 1 if self.narrow else -(-reach.bit_length() // bits) + 1
        if self.narrow:
            self.norms = np.array(norms, np.int64)
        else:
            mask = (1 << bits) - 1
            self.norms = np.array([[n >> bits * k & mask for k in range(self.digits)]
                                   for n in norms], np.int64)

    def products(self, x: np.ndarray) -> dict[int, np.ndarray]:
        """Dot products of limb-split rows with all entries, by limb weight, as int64."""
        out: dict[int, np.ndarray] = {}
        for a in range(self.limbs):
            for b in range(self.limbs):
                p = (x[a] @ self.parts[b].T).astype(np.int64)
                out[a + b] = out[a + b] + p if a + b in out else p
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Index of the first nearest entry of each row, and |c|^2 - 2 x.c of it where
        int64 holds it (else None)."""
        found = self.products(x)
        if self.narrow:
            score = self.norms - 2 * sum(p << self.bits * k for k, p in found.items())
            best = score.argmin(1)
            return best, score[np.arange(len(best)), best]
        mask = (1 << self.bits) - 1
        carry = np.zeros((x.shape[1], len(self.entries)), np.int64)
        digits = []
        for k in range(self.digits):
            value = carry + self.norms[:, k] - 2 * found.get(k, 0)
            digits.append(value & mask)
            carry = value >> self.bits
        alive = np.ones(carry.shape, bool)
        for d in [carry, *reversed(digits)]:
            seen = np.where(alive, d, np.iinfo(np.int64).max)
            alive &= seen == seen.min(1, keepdims=True)
        return alive.argmax(1), None


# ----------------------------------------------------------------------------
# Rows of integers
# ----------------------------------------------------------------------------

def kept(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """The rows whose vectors are finite throughout, with ``ints``: floor(4096 * x) as a packed
    array of little-endian doubles."""
    v = F.col(f"`{vector_col}`").cast("array<double>")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf"))
    good = df.where(F.col(f"`{vector_col}`").isNotNull() & F.forall(v, finite))
    packed = good.select(*[c for c in good.columns if c != vector_col], v.alias("__v"))
    fields = [f for f in packed.schema.fields if f.name != "__v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("__v")
            flat = np.asarray(vectors.flatten())
            ends = np.concatenate([[0], np.cumsum(np.asarray(vectors.value_lengths()))])
            ints = np.floor(flat * SCALE) + 0.0  # no negative zero
            ints = pa.array([ints[a:b].astype("<f8").tobytes()
                             for a, b in zip(ends[:-1], ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), ints],
                names=[*(f.name for f in fields), "ints"])
    return packed.mapInArrow(run, T.StructType([*fields, T.StructField("ints", T.BinaryType())]))


def _slices(batches: Iterator[pa.RecordBatch], width: int):
    """(batch, integers as doubles: rows x parts x width), of at most SLICE rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE):
            part = batch.slice(lo, SLICE)
            flat = np.frombuffer(b"".join(part.column("ints").to_pylist()), "<f8")
            yield part, flat.reshape(part.num_rows, PARTS, width)


def _sums(batches: Iterator[pa.RecordBatch], books: list[Codebook],
          width: int) -> Iterator[pa.RecordBatch]:
    """This task's count and limb sums per (part, entry) and component."""
    bits, limbs = books[0].bits, books[0].limbs
    counts = np.zeros((PARTS, ENTRIES), np.int64)
    totals = np.zeros((PARTS, ENTRIES, limbs, width), np.int64)
    for part, x in _slices(batches, width):
        for p, book in enumerate(books):
            here = split(x[:, p], bits, limbs)
            best, _ = book.nearest(here)
            counts[p] += np.bincount(best, minlength=ENTRIES)
            chosen = (best == np.arange(ENTRIES)[:, None]).astype(np.float64)
            for k in range(limbs):  # SLICE limbs add up to less than 2^53
                totals[p, :, k] += (chosen @ here[k]).astype(np.int64)
    at = np.argwhere(counts > 0)
    if len(at):
        yield pa.RecordBatch.from_arrays([
            pa.array(at[:, 0].astype(np.int32)), pa.array(at[:, 1].astype(np.int32)),
            pa.array([counts[p, e] for p, e in at], pa.int64()),
            pa.array([totals[p, e].ravel().tolist() for p, e in at], pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"])


def _codes(batches: Iterator[pa.RecordBatch], books: list[Codebook], width: int,
           columns: list[str]) -> Iterator[pa.RecordBatch]:
    bits, limbs = books[0].bits, books[0].limbs
    for part, x in _slices(batches, width):
        codes = np.empty((len(x), PARTS), np.int64)
        error = np.zeros(len(x), np.int64)
        wide: list[int] | None = None
        for p, book in enumerate(books):
            here = split(x[:, p], bits, limbs)
            codes[:, p], score = book.nearest(here)
            reach = max(np.abs(x[:, p]).max(initial=0), book.largest)
            if score is not None and wide is None and PARTS * width * (2 * reach) ** 2 < 2 ** 62:
                own = x[:, p].astype(np.int64)
                error += (own * own).sum(1) + score
            else:
                wide = wide or error.tolist()
                for r, (row, e) in enumerate(zip(x[:, p].tolist(), codes[:, p])):
                    wide[r] += sum((int(a) - b) ** 2 for a, b in zip(row, book.entries[e]))
        if wide is not None:
            error = [e if e < 1 << 63 else None for e in wide]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in columns),
             pa.array(["".join(f"{e:02x}" for e in row) for row in codes]),
             pa.array(error, pa.int64())], names=[*columns, "code", "error"])


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, list]:
    """vec_id, label, code (two hex digits a part) and error of every kept row, and the
    codebooks: entries of integers by part."""
    scratch = Scratch(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                     F.col(f"`{vector_col}`").alias("embedding"))
    rows = scratch.stage(kept(rows).withColumn("length", (F.octet_length("ints") / 8).cast("int")),
                         "codes-ints")
    none = df.sparkSession.createDataFrame([], T.StructType(
        [rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()),
         T.StructField("error", T.LongType())]))
    # the first entries, and with them the length: ids ascending (nulls last), then components
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "length").select("length").first()
    if first is None:
        return none, [[] for _ in range(PARTS)]
    length = first["length"]
    rows = rows.where(F.col("length") == length)
    width = -(-length // PARTS)
    gap = width * PARTS - length
    if gap:
        rows = rows.withColumn("ints", F.concat("ints", F.lit(bytearray(8 * gap))))
    start = _smallest(rows)
    largest = max(1, rows.select("ints").mapInArrow(_largest, "m double").agg(F.max("m")).first()[0])
    bits = limb_bits(width)
    limbs = limbs_needed(int(largest), bits)
    books = [[list(map(int, v[p * width:(p + 1) * width])) for v in start] for p in range(PARTS)]
    for _ in range(rounds):
        now = [Codebook(b, bits, limbs) for b in books]
        added = rows.select("ints").mapInArrow(
            lambda x, now=now: _sums(x, now, width),
            "part int, entry int, n bigint, sums array<bigint>")
        found = added.select("part", "entry", "n", F.posexplode("sums").alias("at", "s")) \
            .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        sums: dict[tuple[int, int], list[int]] = {}
        counts: dict[tuple[int, int], int] = {}
        for r in found.collect():  # PARTS * ENTRIES * limbs * width rows at most
            k, c = divmod(r["at"], width)
            sums.setdefault((r["part"], r["entry"]), [0] * width)[c] += r["s"] << bits * k
            counts[r["part"], r["entry"]] = r["n"]
        books = [[[s // counts[p, e] for s in sums[p, e]] if (p, e) in sums else entry
                  for e, entry in enumerate(book)] for p, book in enumerate(books)]
    last = [Codebook(b, bits, limbs) for b in books]
    schema = T.StructType([*none.schema.fields])
    return rows.select("vec_id", "label", "ints").mapInArrow(
        lambda x: _codes(x, last, width, ["vec_id", "label"]), schema), books


def _largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<f8")
        yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(flat).max(initial=0))])],
                                         names=["m"])


def _smallest(rows: DataFrame) -> list[np.ndarray]:
    """Vectors of the ``ENTRIES`` smallest ids; rows that share an id are ordered by
    components. Tasks keep their own ``ENTRIES`` first rows only."""
    ids = rows.select("vec_id").orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES).collect()
    last = ids[-1]["vec_id"]
    near = rows if last is None else rows.where(F.col("vec_id") <= last)
    unpacked = near.select("vec_id", "ints").mapInArrow(_unpack, T.StructType(
        [rows.schema["vec_id"], T.StructField("v", T.ArrayType(T.DoubleType()))]))
    top = unpacked.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    return [np.array(r["v"]) for r in top]


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = [np.frombuffer(x, "<f8").tolist() for x in batch.column("ints").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(
            v, pa.list_(pa.float64()))], names=["vec_id", "v"])


def codebooks_digest(books: list) -> str:
    flat = ",".join(str(v) for book in books for entry in book for v in entry)
    return hashlib.sha256(flat.encode()).hexdigest()


def digest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (summed over equal labels, nulls together) and
    codebooks_sha256 (all entries by part, entry and position)."""
    scratch = Scratch(df.sparkSession)
    coded, books = compress(df, id_col, vector_col, label_col)
    coded = scratch.stage(coded, "codes")
    sums = coded.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("total"),
        F.count_if(F.col("error").isNull()).alias("missing"))
    sums = scratch.stage(sums.select(
        F.col("label").alias("of"), F.when(F.col("missing") == 0, F.col("total")).try_cast("bigint")
        .alias("label_error")), "codes-labels")
    small, _ = broadcast_if_small(sums)
    return coded.join(small, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
