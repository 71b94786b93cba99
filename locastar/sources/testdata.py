"""Reader for the input parquet tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; selecting ``cols`` prunes the scan."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df
