"""Consecutive numbers in a total order without a global window: range partitions, numbered inside, plus offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.session import cut


def numbered(df: DataFrame, order: list[Column], name: str = "n", partitions: int | None = None) -> DataFrame:
    """``df`` with the number of each row in ``order``, from 1. Ties have numbers one after the other, in any order.

    What is broadcast is one row per partition.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the partitions must not change between counting and numbering
    ranged = cut(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    offsets = sizes.withColumn("__offset", F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__size")
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.withColumn("__row", inside).join(F.broadcast(offsets), "__part").withColumn(name, F.col("__offset") + F.col("__row")).drop("__part", "__row", "__offset")


def dealt(df: DataFrame, order: list[Column], shards: int = 300, name: str = "shard") -> DataFrame:
    """``df`` with shard numbers 1 to ``shards`` dealt in turn along ``order``."""
    return numbered(df, order, "__n").withColumn(name, ((F.col("__n") - 1) % shards + 1).cast("int")).drop("__n")


def running(df: DataFrame, order: list[Column], value: Column, n: str = "n", total: str = "running") -> DataFrame:
    """``df`` numbered in ``order`` and with the running sum of ``value``, by partitions and offsets alike."""
    placed = numbered(df.withColumn("__value", value), order, n)
    width = 1 << 16
    block = F.floor((F.col(n) - 1) / width)
    sums = placed.groupBy(block.alias("__block")).agg(F.sum("__value").alias("__sum"))  # one row per 65536 rows
    offsets = numbered_sums(sums)
    inside = F.sum("__value").over(Window.partitionBy("__block").orderBy(n).rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("__block", block).withColumn("__inside", inside).join(offsets, "__block").withColumn(total, F.col("__offset") + F.col("__inside")).drop("__block", "__inside", "__offset", "__value")


def numbered_sums(sums: DataFrame) -> DataFrame:
    """``__block``, ``__offset``: what comes before each block; the blocks are few (one per 65536 rows) and narrow."""
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("__block", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
