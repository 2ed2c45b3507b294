"""Work lists and idempotent writes over tables without row-level updates.

Keys that are unique by contract are made so on the way in (the first or last arrival wins); each write is an
anti join or a window over old and new rows, so running it twice gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Outcomes that a retry would not change.
FINAL_ERRORS = [
    "connection_failed_429", "connection_failed_403", "connection_failed_500", "connection_failed_200", "connection_failed_503", "connection_failed_404", "connection_failed_522", "connection_failed_502", "connection_failed_406", "connection_failed_408",
]
FINAL_PREFIX = "A child process terminated abruptly"


def work_list(todo: DataFrame, done: DataFrame, key: str = "domain", after: str = "", shard: int | None = None, shards: int = 1, batch: int | None = None) -> DataFrame:
    """The keys still to do, in order: after the last one handled, of one shard, at most a batch."""
    out = todo.filter(F.col(key) > after) if after else todo
    if shard is not None:
        out = out.filter(shard_of(key, shards) == shard)
    out = out.join(done.select(key), key, "left_anti")
    return out.orderBy(key).limit(batch) if batch else out


def shard_of(key: str, shards: int) -> Column:
    """A shard by the first 32 bits of the MD5, which any system can recompute."""
    return F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("long") % shards


def first_arrivals(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__rn = 1").drop("__rn")


def insert_ignore(target: DataFrame, new: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``target`` and the first arrival of each new key."""
    return target.unionByName(first_arrivals(new, key, order).join(target.select(*key), key, "left_anti"), allowMissingColumns=True)


def upsert(target: DataFrame, new: DataFrame, key: list[str], order: list[Column], keep: list[str] = ()) -> DataFrame:
    """``target`` with the last arrival of each new key in place of its row; columns in ``keep`` stay as they were."""
    last = first_arrivals(new, key, order)
    if not keep:
        return target.join(last.select(*key), key, "left_anti").unionByName(last)
    old = target.select(*key, F.lit(True).alias("__there"), *[F.col(c).alias(f"__{c}") for c in keep])
    merged = last.join(old, key, "left").withColumns({c: F.when(F.col("__there"), F.col(f"__{c}")).otherwise(F.col(c)) for c in keep})
    return target.join(last.select(*key), key, "left_anti").unionByName(merged.select(*target.columns))


def fill_missing(target: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` from ``updates`` where ``target`` has none."""
    new = updates.select(key, F.col(column).alias("__new"))
    return target.join(new, key, "left").withColumn(column, F.coalesce(column, "__new")).drop("__new")


def overwrite(target: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``columns`` from ``updates`` wherever the key matches, nulls included."""
    new = updates.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    return target.join(new, key, "left").withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}).select(*target.columns)


def is_transient(error: str = "error_msg") -> Column:
    """An error that a retry may clear."""
    e = F.col(error)
    return e.isNotNull() & (e != "") & ~e.isin(FINAL_ERRORS) & ~e.startswith(FINAL_PREFIX)


def delete_transient(crawl: DataFrame) -> DataFrame:
    return crawl.filter(~is_transient())


def copy_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """The columns both tables have, in the target's order and types."""
    shared = [c for c in target.columns if c in set(source.columns)]
    kinds = dict(target.dtypes)
    return source.select(*[F.col(c).cast(kinds[c]).alias(c) for c in shared])


def split_bad(rows: DataFrame, schema: str, key: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON rows as records and the rows that are none or lack their key: bad data is put aside, so that only transient failures are tried again."""
    parsed = rows.withColumn("__r", F.from_json(column, f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    good = F.col("__r.__bad").isNull() & F.col(f"__r.{key}").isNotNull()
    return parsed.filter(good).select("__r.*").drop("__bad"), parsed.filter(~F.coalesce(good, F.lit(False))).drop("__r")
