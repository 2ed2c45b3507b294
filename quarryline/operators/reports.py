"""Fixed reports: every figure of a report comes from one pass over its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.session import cut

# What negative status codes stand for.
STATUS_LABELS = {200: "OK", -1: "timeout", -2: "dns", -3: "connection", -4: "ssl", -5: "redirects", -6: "other"}


def counts_by(df: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Rows by value, most first, ties by value."""
    key = F.coalesce(column, F.lit(missing)) if missing is not None else F.col(column)
    return df.groupBy(key.alias(column)).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), F.col(column).asc_nulls_last())


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Rows by value with their percentage of all."""
    by = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    return by.join(total, F.lit(True)).select(column, "cnt", F.round(F.col("cnt").cast("double") * 100.0 / F.col("total").cast("double"), 1).alias("pct"))


def whole_percent(part: Column, whole: Column) -> Column:
    """The percentage without its fraction; 0 of 0 is 0."""
    return F.when(whole > 0, F.floor(part * 100 / whole)).otherwise(F.lit(0)).cast("long")


def stats(metadata: DataFrame, contacts: DataFrame, employees: DataFrame) -> DataFrame:
    """The figures of the overview: one row."""
    m = metadata.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct("domain").alias("total_domains"), F.count_if(F.col("status_code") == 200).alias("reachable"))
    c = contacts.agg(F.count(F.lit(1)).alias("total_contacts"), F.countDistinct("domain").alias("domains_with_contacts"))
    e = employees.agg(F.count(F.lit(1)).alias("total_employees"))
    return m.join(c, F.lit(True)).join(e, F.lit(True))


def crawl_report(metadata: DataFrame, crawl: DataFrame) -> DataFrame:
    """Progress of the crawl: one row."""
    blank = F.col("error_msg").isNull() | (F.col("error_msg") == "")
    target = metadata.agg(F.count_if(F.col("status_code") == 200).alias("targets"))
    got = crawl.agg(
        F.count(F.lit(1)).alias("crawled"), F.count_if(F.col("contacts_found") > 0).alias("with_contacts"), F.count_if((F.col("contacts_found") == 0) & blank).alias("empty"), F.count_if(~blank).alias("errors")
    )
    one = target.join(got, F.lit(True))
    return one.withColumns(
        {
            "crawled_pct": whole_percent(F.col("crawled"), F.col("targets")),
            "remaining": F.col("targets") - F.col("crawled"),
            "success_pct": whole_percent(F.col("with_contacts"), F.col("crawled")),
            "empty_pct": whole_percent(F.col("empty"), F.col("crawled")),
            "error_pct": whole_percent(F.col("errors"), F.col("crawled")),
        }
    )


def latency_bucket(ms: str = "fetch_ms") -> Column:
    c = F.col(ms)
    return F.when(c < 1000, "<1s").when(c < 5000, "1-5s").when(c < 12000, "5-12s").otherwise(">12s")


def error_class(status: str = "status_code", error: str = "error_msg") -> Column:
    """The kind of outcome; the order of the rules matters."""
    s = F.col(status)
    failed = F.contains(F.coalesce(error, F.lit("")), F.lit("connection_failed"))
    return F.when(s == 200, "success").when(s == -1, "timeout").when(s == -2, "dns_fail").when(s.isin(-3, -6), "conn_error").when(s == -4, "ssl_error").when(failed, "conn_error").otherwise("other")


def status_label(status: str = "status_code") -> Column:
    labels = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    return F.coalesce(labels[F.col(status)], F.concat(F.lit("HTTP "), F.col(status).cast("string")))


def latest(df: DataFrame, by: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.col(by).desc()).limit(n)


def rolling_errors(df: DataFrame, order: str, is_error: Column, items: int = 500, warn: int = 400) -> DataFrame:
    """Errors among the last ``items`` rows, and whether that passes the warning mark.

    The sum of a window is the difference of two running sums, so no window spans the table; ``order`` has no ties.
    """
    from quarryline.operators.ranks import running

    summed = cut(running(df, [F.col(order)], is_error.cast("int"), "__n", "__sum"))
    back = summed.select((F.col("__n") + items).alias("__n"), F.col("__sum").alias("__before"))
    out = summed.join(back, "__n", "left").withColumn("recent_errors", F.col("__sum") - F.coalesce("__before", F.lit(0)))
    return out.withColumn("warn", F.col("recent_errors") > warn).drop("__n", "__sum", "__before")


def progress(df: DataFrame, pending: int, seconds: float) -> DataFrame:
    """Progress of a crawl from its status rows: one row with rate, minutes left, contacts, errors and their share, and rows by outcome."""
    kind = error_class()
    n = F.count(F.lit(1))
    kinds = ["success", "dns_fail", "timeout", "conn_error", "ssl_error", "other"]
    counted = df.agg(n.alias("crawled"), F.coalesce(F.sum("contacts_found"), F.lit(0)).alias("contacts"), *[F.count_if(kind == k).alias(k) for k in kinds])
    errors = F.col("crawled") - F.col("success")
    rate = F.col("crawled") / F.lit(float(seconds)) if seconds > 0 else F.lit(0.0)
    left = F.greatest(F.lit(pending) - F.col("crawled"), F.lit(0))
    return counted.withColumns(
        {
            "rate": F.round(rate, 1), "minutes_left": F.when(rate > 0, F.round(left / rate / 60, 0)).otherwise(F.lit(0.0)),
            "errors": errors, "error_pct": F.when(F.col("crawled") > 0, F.round(errors * 100.0 / F.col("crawled"), 1)).otherwise(F.lit(0.0)),
        }
    )


def insights(cards: DataFrame, order: list[Column], sample: int = 20, most: int = 5) -> DataFrame:
    """``kind``, ``key``, ``n`` of the first ``sample`` cards: the most frequent categories and places (the text before the first comma), and contacts by kind."""
    few = cards.orderBy(*order).limit(sample)
    category = few.groupBy(F.lit("category").alias("kind"), F.coalesce(F.nullif("category", F.lit("")), F.lit("unknown")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    place = F.left(F.trim(F.substring_index(F.trim("location"), ",", 1)), F.lit(30))
    places = few.select(place.alias("key")).filter("key <> ''").groupBy(F.lit("location").alias("kind"), "key").agg(F.count(F.lit(1)).alias("n"))
    top = lambda d: d.orderBy(F.col("n").desc(), "key").limit(most)
    kinds = {"email": "email_count", "phone": "phone_count", "linkedin": "linkedin_count"}
    sums = few.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in kinds.items()])
    contacts = sums.select(F.explode(F.create_map(*[x for k in kinds for x in (F.lit(k), F.col(k))])).alias("key", "n")).select(F.lit("contact").alias("kind"), "key", "n")
    return top(category).unionByName(top(places)).unionByName(contacts)


def filter_options(metadata: DataFrame, contacts: DataFrame) -> DataFrame:
    """``kind``, ``value`` of the choices of each filter: categories, the first 50 languages, contact types."""
    category = metadata.filter("category is not null").select(F.lit("category").alias("kind"), F.col("category").alias("value")).distinct()
    language = metadata.filter("language is not null and status_code = 200").select("language").distinct().orderBy("language").limit(50)
    kinds = contacts.select(F.lit("contact_type").alias("kind"), F.col("entity_type").alias("value")).distinct()
    return category.unionByName(language.select(F.lit("language").alias("kind"), F.col("language").alias("value"))).unionByName(kinds)
