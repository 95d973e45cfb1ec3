"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


class Tables:
    """Lazy parquet readers for one directory of ``<name>.parquet`` tables.

    Nothing is read until a query runs; Spark prunes columns and pushes the
    role filters (``event_type = ...``) into the parquet scan. Each table's
    reader is created once (one schema look-up) and shared by all roles.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._frames[name]
