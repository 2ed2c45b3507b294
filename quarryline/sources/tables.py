"""Reading the lead tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``; column pruning and pushed filters are left to the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
