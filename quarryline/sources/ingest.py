"""Raw sources: crawl-index lines, certificate lists, zone files, key lists, relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.functions.domains import certificate_root, site_domain, zone_domain

CERTIFICATES = T.StructType([T.StructField("name_value", T.StringType()), T.StructField("not_before", T.StringType())])


def crawl_index(lines: DataFrame, shard: str | None = None) -> DataFrame:
    """``domain``, ``last_crawled``, ``shard`` of index lines that are pages: key, time and a JSON tail, status 200, HTML or no type."""
    part = F.split("value", " ", 3)
    tail = F.get(part, F.lit(2))
    meta = lambda k: F.get_json_object(tail, f"$.{k}")
    mime = F.lower(F.coalesce(meta("mime"), F.lit("")))
    rows = lines.filter(F.size(part) == 3).select(meta("status").alias("status"), mime.alias("mime"), site_domain(meta("url")).alias("domain"), F.get(part, F.lit(1)).alias("last_crawled"))
    rows = rows.filter((F.col("status") == "200") & ((F.col("mime") == "") | F.contains("mime", F.lit("html"))) & F.col("domain").isNotNull())
    return rows.groupBy("domain").agg(F.min("last_crawled").alias("last_crawled")).withColumn("shard", F.lit(shard).cast("string"))


def read_crawl_index(spark: SparkSession, path: str, shard: str | None = None) -> DataFrame:
    """The index files under ``path``; compressed files are decoded by the reader."""
    return crawl_index(spark.read.text(path), shard)


def certificates(spark: SparkSession, path: str) -> DataFrame:
    """The domains named by certificate lists (JSON arrays)."""
    rows = spark.read.schema(CERTIFICATES).json(path, multiLine=True)
    names = rows.select(F.explode(F.split("name_value", r"\n")).alias("name"))
    return names.select(certificate_root("name").alias("domain")).filter("domain is not null").distinct()


def zone(lines: DataFrame) -> DataFrame:
    """The domains of a zone file's lines."""
    return lines.select(zone_domain("value").alias("domain")).filter("domain is not null").distinct()


def keys(spark: SparkSession, values: list[str], name: str = "domain") -> DataFrame:
    """A list of keys as a table, in its order."""
    return from_arrays(spark, **{name: values})


def from_arrays(spark: SparkSession, **columns: list) -> DataFrame:
    """Parameter arrays side by side as a table with their positions; shorter ones end in nulls."""
    kinds = {str: "string", int: "long", float: "double", bool: "boolean"}
    lits = [F.lit(v).cast(f"array<{next((kinds[type(x)] for x in v if x is not None), 'string')}>") if v else F.array().cast("array<string>") for v in columns.values()]
    zipped = F.arrays_zip(*[a.alias(c) for a, c in zip(lits, columns, strict=True)])
    return spark.range(1).select(F.posexplode(zipped).alias("pos", "x")).select("pos", *[F.col(f"x.{c}") for c in columns])


def has_table(spark: SparkSession, name: str, columns: list[str] = ()) -> bool:
    """Whether a table is known and has the columns."""
    return spark.catalog.tableExists(name) and set(columns) <= set(spark.table(name).columns)


def write_table_over_jdbc(df: DataFrame, url: str, table: str, batch: int = 50_000, **options: str) -> None:
    """Rows appended to a relational table, a batch per round trip."""
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).option("batchsize", batch)
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.save()


def read_table_over_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, pieces: int, **options: str) -> DataFrame:
    """A relational table read in ranges of a numeric key, one task a range."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", pieces)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


TEXT_FIELDS = ("title", "description", "language", "location")
# Answers after which a fetch is tried once more.
RETRIED = (429, 500, 502, 503, 504)


def fetch_outcome(log: DataFrame) -> DataFrame:
    """Replayed fetch logs as status rows, one a domain: failures as negative codes, texts only of pages that answered with HTML.

    The last try of a domain counts: a later one follows an answer in ``RETRIED``, or, without encryption, a failure of the
    certificate. ``log`` has ``domain``, ``try``, ``failure``, ``http_status``, ``content_type`` and any text fields.
    """
    codes = {"timeout": -1, "dns": -2, "connection": -3, "ssl": -4, "redirects": -5}
    failed = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    columns = ["failure", "http_status", "content_type", *[c for c in TEXT_FIELDS if c in log.columns]]
    last = log.groupBy("domain").agg(F.max_by(F.struct(*columns), "try").alias("l")).select("domain", "l.*") if "try" in log.columns else log
    code = F.when(F.col("failure").isNull(), F.col("http_status")).otherwise(F.coalesce(failed[F.col("failure")], F.lit(-6)))
    good = (code == 200) & F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("html"))
    return last.select("domain", code.alias("status_code"), *[F.when(good, F.col(c)).alias(c) for c in columns[3:]], F.col("failure").alias("error_msg"))


def may_retry(status: str = "http_status", failure: str = "failure") -> Column:
    """Whether a first try is followed by another."""
    return F.coalesce(F.col(status).isin(*RETRIED), F.lit(False)) | F.coalesce(F.col(failure) == "ssl", F.lit(False))
