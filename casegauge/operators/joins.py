"""Join helpers: size-checked broadcast and lineage cuts on the shared scratch folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.session import scratch_root

# Bounds a broadcast side must meet: rows, and an estimate of its bytes (string lengths
# plus fixed-width columns) -- rows alone say nothing once rows carry texts.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir`` (shared storage
    on a cluster, so it survives executor loss). Use for small derived tables that are
    counted and then joined, so they are computed once."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


# bytes of the fixed-width types (others count 8)
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
          T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16}


def estimated_bytes(df: DataFrame) -> Column:
    """An aggregate estimating the size of ``df``'s rows: the UTF-8 length of every string
    and binary column plus the default size of every other column."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_WIDTH.get(type(f.dataType), 8)))
    row = F.lit(0) if not parts else reduce(lambda a, b: a + b, parts)
    return F.sum(row.cast("long"))


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when its row count is within ``max_rows`` and its estimated
    size within ``max_bytes`` (one aggregate computes both).

    ``df`` should already be materialized (measuring it is then a cheap scan of the
    checkpoint). Beyond either bound the plain DataFrame is returned and the join falls
    back to a shuffle join, which AQE may still turn into a broadcast or split if skewed.
    """
    m = df.agg(F.count(F.lit(1)).alias("n"), estimated_bytes(df).alias("b")).first()
    small = m["n"] <= max_rows and (m["b"] or 0) <= max_bytes
    return (F.broadcast(df), True) if small else (df, False)
