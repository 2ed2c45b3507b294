"""Joins whose hot keys are spread, and broadcasts of checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least this share of the rows of its group is joined by broadcast.
HOT = 0.001
#: Tables of at most so many narrow rows are broadcast.
MOST_ROWS = 100_000


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], share: str) -> DataFrame:
    """The inner join of ``left`` with ``right``, which has each key once and in ``share`` its share of the rows of its group.

    Keys of at least ``HOT`` are broadcast; a group has at most ``1 / HOT`` of them, however large it is.
    """
    hot = F.broadcast(right.filter(F.col(share) >= HOT).drop(share))
    cold = right.filter(F.col(share) < HOT).drop(share)
    return left.join(hot, keys).unionByName(left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys))


def broadcast_checked(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows; else left to the planner."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
