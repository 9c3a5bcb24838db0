"""Tables filed by key bucket: a base with one folder per bucket, and deltas appended by each
call until they are merged into it (S7 G7 P20 U2).

Layout under a table's folder: ``base/bucket=B/`` and ``delta/part=P/bucket=B/``, where B is
``pmod(xxhash64(key), n)``. A write appends one delta; a read merges base and deltas; reading
one key, or some keys, opens their buckets' files only (partition pruning). ``compact`` merges
the deltas into the buckets that they touch and leaves all others as they are:

1. the touched buckets, merged, are written to ``staged/``, and ``staged/_DONE`` names the
   deltas that they hold;
2. each staged bucket takes the place of its old one (delete, rename);
3. the named deltas, then ``staged/``, are removed.

A crash in step 1 leaves the table as it was; after ``_DONE`` is written, the next open goes
on with step 2: the staged copy keeps a bucket until it stands in its place. Merging a
delta twice changes nothing, because rows carry the unique ``row_key`` that ``append`` gives
them, or are reduced to one per key. Appends may run side by side; one process compacts at a
time, and a reader that planned its files before a swap has to plan again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.sources.files import holds_parts, listed

MADE = "_buckets="  # an empty file whose name holds a table's number of buckets
Merge = Callable[[DataFrame], DataFrame]
# a new table's number of buckets, unless its maker names another (many more for large stores)
BUCKETS = 16
COMPACT_AFTER = 8  # deltas


class BucketTable:
    """One table. ``schema``: its columns; ``merge``: reduces base and delta rows to the
    current ones, so that merging in steps gives the same (latest per key, distinct rows).
    ``n``: buckets of a new table; an old one keeps the number that it was made with."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType,
                 merge: Merge, n: int = BUCKETS):
        self.spark, self.path, self.key, self.merge = spark, path.rstrip("/"), key, merge
        made = [f for f in listed(spark, self.path, folders=False) if f.startswith(MADE)]
        self.schema, self.n = schema, int(made[0][len(MADE):]) if made else n
        self._stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        self._delta = T.StructType([*schema.fields, T.StructField("part", T.StringType()),
                                    T.StructField("bucket", T.IntegerType())])
        self._settle()

    # -- reading -----------------------------------------------------------------

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.n)).cast("int")

    def _folder(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.path}/{name}"
        if not holds_parts(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(path)

    def rows(self) -> DataFrame:
        """Base and delta rows, not merged, with their ``bucket``."""
        return self._folder("base", self._stored).unionByName(
            self._folder("delta", self._delta).drop("part"))

    def read(self) -> DataFrame:
        """The current rows."""
        return self.merge(self.rows().drop("bucket")).select(*self.schema.fieldNames())

    def at(self, key) -> DataFrame:
        """The current rows of one key, from its bucket's files."""
        here = self.rows().where(F.col("bucket") == self.bucket_of(F.lit(key).cast(
            self.schema[self.key].dataType))).where(F.col(self.key) == key)
        return self.merge(here.drop("bucket")).select(*self.schema.fieldNames())

    # -- writing -----------------------------------------------------------------

    def append(self, rows: DataFrame, part: str, unique: bool = False) -> None:
        """Add rows as the delta ``part`` (a name given again replaces its delta: a replayed
        call is harmless). ``unique``: rows get a ``row_key`` of the part and their place."""
        if unique:
            rows = rows.withColumn("row_key", F.concat(
                F.lit(f"{part}:"), F.monotonically_increasing_id().cast("string")))
        fs, made = self._fs(f"{self.path}/{MADE}{self.n}")
        if not fs.exists(made):
            fs.create(made, True).close()
        bucketed = rows.select(*self.schema.fieldNames()).withColumn(
            "bucket", self.bucket_of(F.col(self.key)))
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket") \
            .parquet(f"{self.path}/delta/part={part}")
        if len(self.deltas()) >= COMPACT_AFTER:
            self.compact()

    def upsert(self, rows: DataFrame, part: str) -> None:
        """Merge rows into the base at once: only their keys' buckets are written."""
        self.append(rows, part)
        self.compact()

    def deltas(self) -> list[str]:
        return [d for d in listed(self.spark, f"{self.path}/delta", folders=True)
                if d.startswith("part=")]

    def compact(self) -> list[int]:
        """Merge all deltas into the base; the buckets that were written."""
        parts = self.deltas()
        touched = sorted({int(d.split("=")[1]) for p in parts
                          for d in listed(self.spark, f"{self.path}/delta/{p}", folders=True)
                          if d.startswith("bucket=")})
        if not touched:  # deltas without rows
            for part in parts:
                fs, at = self._fs(f"{self.path}/delta/{part}")
                fs.delete(at, True)
        else:
            old = self._folder("base", self._stored).where(F.col("bucket").isin(touched))
            new = self._folder("delta", self._delta) \
                .where(F.col("part").isin([p.split("=", 1)[1] for p in parts])).drop("part")
            merged = self.merge(old.unionByName(new).drop("bucket")) \
                .select(*self.schema.fieldNames()).withColumn("bucket", self.bucket_of(F.col(self.key)))
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket") \
                .parquet(f"{self.path}/staged")
            self._note(json.dumps(parts))
            self._settle()
        return touched

    # -- the swap ----------------------------------------------------------------

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _note(self, text: str) -> None:
        fs, at = self._fs(f"{self.path}/staged/_DONE")
        out = fs.create(at, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _settle(self) -> None:
        """Finish a swap that was begun (steps 2 and 3); nothing to do otherwise."""
        fs, done = self._fs(f"{self.path}/staged/_DONE")
        if not fs.exists(done):
            return
        stream = fs.open(done)
        parts = json.loads(bytes(stream.readAllBytes()).decode())
        stream.close()
        for folder in listed(self.spark, f"{self.path}/staged", folders=True):
            if folder.startswith("bucket="):
                _, new = self._fs(f"{self.path}/staged/{folder}")
                _, old = self._fs(f"{self.path}/base/{folder}")
                fs.mkdirs(old.getParent())
                fs.delete(old, True)
                if not fs.rename(new, old):
                    raise OSError(f"{new} can't take the place of {old}")
        for part in parts:
            fs.delete(self._fs(f"{self.path}/delta/{part}")[1], True)
        fs.delete(done.getParent(), True)
