"""Positions in a total order, without gathering the rows in one task (O1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegauge.operators import joins


def numbered(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with ``name``: each row's 1-based place in the order (which should have no ties:
    tied rows are numbered in any order).

    Rows are range-partitioned and sorted; a row's place is its place in its partition plus the
    rows of the partitions before, which are one small row per partition."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = joins.materialize(dealt.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    small, _ = joins.broadcast_if_small(joins.materialize(starts))
    inside = F.col("__at") - F.shiftleft("__part", 33)
    return placed.withColumn("__part", part).join(small, "__part").withColumn(
        name, F.col("__before") + inside + 1).drop("__part", "__at", "__before")
