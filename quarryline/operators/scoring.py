"""Counts and quality scores of companies, recomputed from contacts and people in one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOCIAL = ["facebook", "instagram", "twitter", "youtube", "whatsapp"]


def contact_counts(contacts: DataFrame, linkedin_prefix: bool = False) -> DataFrame:
    """Contacts of each domain by kind: one conditional aggregation instead of one scan per kind."""
    kind = F.col("entity_type")
    linkedin = kind.startswith("linkedin") if linkedin_prefix else kind == "linkedin"
    return contacts.groupBy("domain").agg(
        F.count_if(kind == "email").alias("emails"), F.count_if(kind == "phone").alias("phones"), F.count_if(linkedin).alias("linkedins"), F.count_if(kind.isin(SOCIAL)).alias("socials")
    )


def quality_score(emails: Column, phones: Column, linkedins: Column, socials: Column, people: Column) -> Column:
    """Points for what is known of a company; an empty text counts as known, a null does not."""
    points = [(emails > 0, 20), (phones > 0, 15), (linkedins > 0, 10), (socials > 0, 5), (people > 0, 15), (F.col("description").isNotNull(), 5), (F.col("location").isNotNull(), 5), (F.col("status_code") == 200, 10), (emails + phones > 2, 10)]
    total = F.lit(0)
    for condition, worth in points:
        total = total + F.when(condition, worth).otherwise(0)
    return total


def score(metadata: DataFrame, contacts: DataFrame, employees: DataFrame, linkedin_prefix: bool = False) -> DataFrame:
    """``metadata`` with its counts and score computed anew."""
    counts = contact_counts(contacts, linkedin_prefix)
    people = employees.groupBy("domain").agg(F.count(F.lit(1)).alias("people"))
    joined = metadata.join(counts, "domain", "left").join(people, "domain", "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("emails", "phones", "linkedins", "socials", "people")}
    out = joined.withColumn("__score", quality_score(*n.values())).withColumns(
        {"email_count": n["emails"].cast("int"), "phone_count": n["phones"].cast("int"), "linkedin_count": n["linkedins"].cast("int"), "social_count": n["socials"].cast("int"), "emp_count": n["people"].cast("int")}
    )
    return out.withColumns({"quality_score": F.col("__score").cast("int"), "_quality_synced": F.lit(True)}).drop("emails", "phones", "linkedins", "socials", "people", "__score")


def quality_class(score: str | Column = "quality_score") -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.when(c >= 60, "high").when(c >= 30, "medium").otherwise("low")


def short_number(c: Column) -> Column:
    """1.2M, 3K, 950."""
    return F.when(c >= 1_000_000, F.format_string("%.1fM", c / 1_000_000)).when(c >= 1000, F.format_string("%.0fK", c / 1000)).otherwise(c.cast("string"))
