"""Top N rows of every group under a total order.

``row_number`` over the group ordered by score and identifier, with a filter on the rank. Catalyst turns
the filter into a group limit that prunes each partition before the shuffle and once more after it, so a
group that holds a third of all rows sends at most N rows per map task.

Defined results: a null group key is a group of its own; null scores come last; ties are broken by the
following order columns; repeated rows all count; groups with fewer than N rows give all of them; an empty
table gives an empty result; other columns, whatever they are called, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank_in_group"


def top_per_group(df: DataFrame, groups: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group; ``rank`` names a column for the position, if it is wanted."""
    if n < 1:
        return df.limit(0) if rank is None else df.limit(0).withColumn(rank, F.lit(0))
    name = rank or RANK
    while name in df.columns and rank is None:
        name += "_"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def best_contacts(contacts: DataFrame, n: int = 3) -> DataFrame:
    """The best-scored contacts of each domain and entity type: score, then newest, then smallest id."""
    order = [F.col("score").desc_nulls_last(), F.col("fetched_at").desc_nulls_last(), F.col("id").asc()]
    return top_per_group(contacts, ["domain", "entity_type"], order, n)
