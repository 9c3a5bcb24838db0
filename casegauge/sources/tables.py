"""Readers for the Parquet tables the engine runs on.

Reads are lazy and schema-on-read from the Parquet footer; callers select only the
columns they use so the scan's ReadSchema is pruned and filters reach PushedFilters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table stored as ``{base}/{name}.parquet`` (a file or a folder of parts)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables under one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.base, name)
