"""Exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEARCH_COLUMNS = ["domain", "category", "title", "location", "contact_type", "contact_value", "contact_label"]
CARD_COLUMNS = ["domain", "title", "category", "location", "quality_score", "email_count", "phone_count", "linkedin_count"]


def for_csv(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as text, nulls as empty."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


def write_csv(df: DataFrame, columns: list[str], path: str) -> None:
    for_csv(df, columns).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def saved_lines(df: DataFrame) -> DataFrame:
    """Saved companies as text lines, the title quoted with its inner quotes replaced."""
    title = F.concat(F.lit('"'), F.translate(F.coalesce("title", F.lit("")), '"', "'"), F.lit('"'))
    return df.select(F.concat_ws(",", "domain", title, F.coalesce("category", F.lit("")), F.coalesce(F.col("quality_score").cast("string"), F.lit(""))).alias("value"))
