"""Helpers shared by the operators of this subpackage.

``stage`` cuts lineage by writing a table to the shared folder named in
``spark.checkpoint.dir`` and reading it back, so a lost executor never loses it and the
work above it runs once. ``Scratch`` frees such tables that nothing reads any more.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegauge.session import scratch_path

# The word and white-space classes of the contracts
# (a word is a maximal run of characters other than space, \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lies (scratch tables of this package)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Scratch tables of one operator call: ``stage`` writes and rereads, ``drop`` frees."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}

    def stage(self, df: DataFrame, purpose: str) -> DataFrame:
        path = scratch_path(self.spark, purpose)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._scratch = path  # keeps id(out) from being reused while it is listed
        return out

    def free(self, *paths: str) -> None:
        """Free folders that the operator wrote itself."""
        for path in paths:
            delete_path(self.spark, path)

    def drop(self, *frames: DataFrame) -> None:
        """Free staged tables whose readers have all run."""
        for df in frames:
            path = self._paths.pop(id(df), None)
            if path:
                delete_path(self.spark, path)


def few(df: DataFrame, rows: int, per_task: int = 1 << 15) -> DataFrame:
    """A table of at most ``rows`` rows, written by one task per ``per_task`` of them: tables
    shrink from step to step, their partitions don't by themselves."""
    return df.coalesce(-(-rows // per_task) or 1)


def count_words(text: Column) -> Column:
    """Words of a text (null: 0), JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


# ----------------------------------------------------------------------------
# Word hashing in numpy: whole batches of texts as one byte buffer
# ----------------------------------------------------------------------------

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 18


def _bytes_table() -> tuple[np.ndarray, np.ndarray]:
    """64-bit value of each byte after lower-casing A-Z, and which bytes end a word."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
    values[65:91] = values[97:123]
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return values, blank


_VALUES, _BLANK = _bytes_table()


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(n, np.uint64)
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled:filled + step] = out[:step] * _U(pow(base, filled, 1 << 64))
        filled += step
    return out


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = _powers(base, max(n, _CHUNK + 2))
        if len(have) <= 64 * _CHUNK:
            _POWERS[base] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _hash_chunk(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of a buffer (no word crosses its ends)."""
    blank = _BLANK[buf]
    edge = np.empty(len(buf) + 1, bool)
    edge[1:-1] = blank[1:] != blank[:-1]
    edge[0] = not blank[0]
    edge[-1] = not blank[-1]
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUES[buf] * powers(_BASE, len(buf)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(_INVERSE, len(buf) + 1)[starts]
    return mix64(h + (ends - starts).astype(np.uint64)), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of many UTF-8 texts, one flat array,
    and the offsets of each text's words in it. Works through the joined bytes in pieces
    of about 256 KiB that end at a blank, so memory doesn't grow with the longest text
    (only with the longest word)."""
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    hashes, starts = [], []
    lo = 0
    while lo < len(buf):
        hi = min(lo + _CHUNK, len(buf))
        while hi < len(buf) and not _BLANK[buf[hi - 1]]:
            step = _BLANK[buf[hi:hi + _CHUNK]]
            hi += int(step.argmax()) + 1 if step.any() else len(step)
        h, s = _hash_chunk(buf[lo:hi])
        hashes.append(h)
        starts.append(s + lo)
        lo = hi
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


def release_memory() -> None:
    """Give freed memory back to the system: an idle worker keeps what it doesn't return, while
    the next stage's tasks need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def text_batches(batches: Iterator[pa.RecordBatch], column: str,
                 limit: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches holding about ``limit`` bytes of texts at most (a longer
    text stands alone), each with the texts as UTF-8 (null: empty)."""
    for batch in batches:
        texts = batch.column(column)
        lengths = np.asarray(pa.compute.fill_null(
            pa.compute.binary_length(texts), 0)).astype(np.int64)
        ends = np.cumsum(lengths)
        lo, done = 0, 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, done + limit, "right")))
            part = batch.slice(lo, hi - lo)
            yield part, [x or b"" for x in
                         part.column(column).cast(pa.large_binary()).to_pylist()]
            lo, done = hi, int(ends[hi - 1])
    release_memory()
