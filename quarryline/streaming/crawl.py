"""Continuous ingestion: files of fetched rows are taken in micro-batches, first arrival of a key wins, replays change nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarryline.operators.maintenance import first_arrivals
from quarryline.session import cut


def new_rows(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """The stream of Parquet files that arrive in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    """The stream of a Parquet table, which is one file or a folder of them."""
    where, files = _found(spark, path)
    rows = spark.readStream.schema(spark.read.parquet(path).schema)
    if files.getFileStatus(where).isDirectory():
        return rows.parquet(path)
    name = where.toString()
    return rows.parquet(f"{name[:-1]}[{name[-1]}]")  # a stream takes a file by a pattern only; its folder would have all tables listed


KEY_BUCKETS = 64


def _found(spark: SparkSession, path: str):
    """The path and the file system it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    where, files = _found(spark, path)
    return files.exists(where)


def ingest_once(stream: DataFrame, target: str, key: str, order: str, checkpoint: str, tables: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> StreamingQuery:
    """Appends each batch's new keys to ``target``; a batch that is replayed is written over itself.

    The keys taken so far are a narrow table of their own, in buckets of the key's hash, so a batch reads the keys of its own
    buckets and never the target. ``tables`` names more tables made of the batch's fresh rows, written before its keys: what
    was interrupted is written again, so all tables end up with the batch or none keeps half of it for good.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")
        fresh = first_arrivals(batch, [key], [F.col(order)]).withColumn("_bucket", bucket)
        if _exists(spark, f"{target}/keys"):
            wanted = [r["_bucket"] for r in fresh.select("_bucket").distinct().collect()]  # at most KEY_BUCKETS
            known = T.StructType([batch.schema[key], T.StructField("_batch", T.LongType()), T.StructField("_bucket", T.IntegerType())])
            done = spark.read.schema(known).parquet(f"{target}/keys").filter(F.col("_bucket").isin(wanted) & (F.col("_batch") != number)).select(key, "_bucket")
            fresh = fresh.join(done, [key, "_bucket"], "left_anti")
        fresh = cut(fresh)
        for name, made in ({"rows": lambda rows: rows} | (tables or {})).items():
            made(fresh.drop("_bucket")).write.mode("overwrite").parquet(f"{target}/{name}/_batch={number}")
        kept = fresh.select(key, "_bucket").withColumn("_batch", F.lit(number))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch", "_bucket").parquet(f"{target}/keys")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status_windows(stream: DataFrame, time: str = "crawled_at", late: str = "2 days", width: str = "1 day") -> DataFrame:
    """Rows and errors of each day and status, rows later than ``late`` left out."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    blank = F.col("error_msg").isNull() | (F.col("error_msg") == "")
    return timed.groupBy(F.window(time, width), "status_code").agg(F.count(F.lit(1)).alias("rows"), F.sum((~blank).cast("int")).alias("errors"))


def without_replays(stream: DataFrame, keys: list[str], time: str, late: str = "7 days") -> DataFrame:
    """Rows whose keys were not seen within the watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def progress_of(query: StreamingQuery) -> dict[str, float]:
    """Rows taken and rows a second of a stream's last batch; zeros before the first."""
    last = query.lastProgress or {}
    return {"batch": float(last.get("batchId", -1)), "rows": float(last.get("numInputRows", 0) or 0), "rows_a_second": float(last.get("processedRowsPerSecond", 0) or 0)}
