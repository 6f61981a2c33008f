"""Table access: parquet in, parquet out.

``Tables`` hands out lazy DataFrames by name. Reading through
``spark.read.parquet`` lets Catalyst prune columns and push filters into
the scan; nothing here triggers a job.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Named parquet tables under one directory (one file or folder each)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        p = f"{self.root}/{name}.parquet"
        return p if os.path.exists(p) or "://" in p else f"{self.root}/{name}"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

