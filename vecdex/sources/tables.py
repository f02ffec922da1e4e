"""Readers for the parquet tables of a data directory.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))


def embeddings_index(spark: SparkSession, data_dir: str) -> DataFrame:
    """The ``embeddings`` table seen as an index: id, vector, label."""
    return table(spark, data_dir, "embeddings").withColumnRenamed(
        "vec_id", "id").withColumnRenamed("embedding", "vector")
