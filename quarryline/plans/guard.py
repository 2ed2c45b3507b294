"""Running queries of users: only plans that read, of the tables given, and no more rows than a cap."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

MAX_ROWS = 200
#: Catalogs of the database the tables came from; never readable.
SYSTEM = ("pg_catalog", "information_schema")


class Refused(ValueError):
    """A statement that may not be run."""


def _nodes(plan) -> list:
    """The plan, its children and the plans inside its expressions."""
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        out.append(p)
        for group in (p.children(), p.innerChildren()):
            todo += [c for i in range(group.size()) if hasattr(c := group.apply(i), "children")]
        subqueries = p.subqueries()
        todo += [subqueries.apply(i) for i in range(subqueries.size())]
    return out


def checked(spark: SparkSession, sql: str) -> str:
    """``sql`` if it is one statement that only reads; else ``Refused``. Words in strings and comments are no statements."""
    text = sql.strip().rstrip(";").strip()
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException as e:
        raise Refused("not a single statement this engine reads") from e
    for node in _nodes(plan):
        kind = node.getClass().getName()
        if "Command" in kind or ".command." in kind or re.search(r"\.(?:Insert|Create|Drop|Alter|Delete|Update|Merge|Replace|Truncate|Set|Use|Show|Describe|Explain|Cache|Refresh|Load|Call|Add)\w*$", kind):
            raise Refused(f"{node.nodeName()} is no query")
        if node.nodeName() == "UnresolvedRelation":
            name = node.multipartIdentifier().mkString(".").lower()
            if any(part in SYSTEM for part in name.split(".")) or re.match(r"(?:parquet|csv|json|orc|text|binaryfile|delta)\.", name):
                raise Refused(f"{name} may not be read")
    return text


def run_query(spark: SparkSession, sql: str, most: int = MAX_ROWS) -> DataFrame:
    """The result of a query that only reads, with at most ``most`` rows whatever limits it has."""
    try:
        return spark.sql(checked(spark, sql)).limit(most)
    except AnalysisException as e:
        if isinstance(e, Refused):
            raise
        raise Refused(str(e).splitlines()[0]) from e
