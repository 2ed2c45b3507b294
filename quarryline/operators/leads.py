"""Serving queries over the lead tables: filters, discovery, search, profiles, options.

All of them are single declarative plans: text filters are ``contains`` on lowered columns, membership of another
table is a semi or anti join, top-k is an ordered limit, contacts of the chosen companies are joined after the
limit so that only k keys reach the contact table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_RESULTS = 200
MAX_EXCLUDED = 2000
COUNT_CAP = 5000
CARD_CONTACTS = 30
# The contact types a discovery card lists.
CARD_TYPES = ["email", "phone", "linkedin", "facebook", "instagram", "twitter", "youtube", "whatsapp"]


def has_text(column: str | Column, text: str) -> Column:
    """Case-insensitive substring match in which ``text`` has no wildcards."""
    return F.contains(F.lower(column), F.lit(text.lower()))


def like_text(column: str | Column, pattern: str) -> Column:
    """Case-insensitive substring match in which ``%`` and ``_`` of the pattern are wildcards."""
    c = F.col(column) if isinstance(column, str) else column
    return c.ilike("%" + pattern.replace("\\", "\\\\") + "%")


def lacks_text(column: str, text: str) -> Column:
    """Null, or without ``text``: the negative filter that keeps rows without a value."""
    return F.col(column).isNull() | ~has_text(column, text)


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def all_of(conditions: list[Column]) -> Column:
    """The conjunction of optional conditions; true for none."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


@dataclass
class Filters:
    """Optional filters; each that is given adds one conjunct."""

    category: list[str] = field(default_factory=list)
    status_code: list[int] = field(default_factory=list)
    language: list[str] = field(default_factory=list)
    location_contains: str | None = None
    title_contains: str | None = None
    description_contains: str | None = None
    domain_contains: str | None = None
    exclude_location: str | None = None
    has_contacts: bool | None = None
    has_employees: bool | None = None
    contact_type: list[str] = field(default_factory=list)
    excluded_domains: list[str] = field(default_factory=list)
    max_excluded: int | None = MAX_EXCLUDED  #: of a longer list only so many count; None for all

    def apply(self, metadata: DataFrame, contacts: DataFrame | None = None, employees: DataFrame | None = None) -> DataFrame:
        parts: list[Column] = []
        for name in ("category", "status_code", "language"):
            if values := getattr(self, name):
                parts.append(F.col(name).isin(values))
        for name in ("location", "title", "description", "domain"):
            if text := getattr(self, f"{name}_contains"):
                parts.append(has_text(name, text))
        if self.exclude_location:
            parts.append(lacks_text("location", self.exclude_location))
        if seen := self.excluded_domains[: self.max_excluded]:
            parts.append(~F.col("domain").isin(seen))
        out = metadata.filter(all_of(parts))
        if self.contact_type:
            out = out.join(contacts.filter(F.col("entity_type").isin(self.contact_type)).select("domain"), "domain", "left_semi")
        if self.has_contacts is not None:
            out = out.join(contacts.select("domain"), "domain", "left_semi" if self.has_contacts else "left_anti")
        if self.has_employees:
            out = out.join(employees.select("domain"), "domain", "left_semi")
        return out


def page(df: DataFrame, order: list[Column], limit: int | None = 100, offset: int | None = 0) -> DataFrame:
    """One page in a total order; the limit is clamped to MAX_RESULTS."""
    return df.orderBy(*order).offset(offset or 0).limit(min(limit or 100, MAX_RESULTS))


def keywords(text: str | None) -> list[str]:
    """The alternatives of ``a OR b``."""
    return [w.strip() for w in (text or "").replace(" OR ", "|").split("|") if w.strip()]


def keyword_filter(text: str, matches: Column | None = None) -> Column:
    """Keyword condition of discovery: the full-text match if there is one, or the first three keywords in title or domain.

    Without a full-text match: the first keyword in title or domain, the second in the title.
    """
    words = keywords(text)
    if matches is not None:
        return reduce(lambda a, w: a | has_text("title", w) | has_text("domain", w), words[:3], matches)
    out = has_text("title", words[0]) | has_text("domain", words[0])
    return out | has_text("title", words[1]) if len(words) > 1 else out


def discover(metadata: DataFrame, filters: Filters, contacts: DataFrame | None = None, employees: DataFrame | None = None, keyword: str | None = None, matches: Column | None = None, batch: int = 10) -> DataFrame:
    """The best-scored companies that answered, by quality and domain."""
    base = metadata.filter((F.col("status_code") == 200) & (F.col("quality_score") > 0))
    if keyword:
        base = base.filter(keyword_filter(keyword, matches))
    found = filters.apply(base, contacts, employees)
    columns = ["domain", "title", "description", "category", "location", "email_count", "phone_count", "linkedin_count", "social_count", "emp_count", "quality_score"]
    order = [F.col("quality_score").desc(), F.col("domain")]
    # each key has a card at least, so the first cards are those of the first keys; only they are compared column by column
    first = found.select("quality_score", "domain").distinct().orderBy(*order).limit(batch)
    return found.select(*columns).join(F.broadcast(first), ["quality_score", "domain"], "left_semi").select(*columns).distinct().orderBy(*order).limit(batch)


def capped_count(df: DataFrame, cap: int = COUNT_CAP) -> DataFrame:
    """How many rows there are, counting no further than ``cap``."""
    return df.select(F.lit(1)).limit(cap).agg(F.count(F.lit(1)).alias("total_matched"))


def has_more(total: int, excluded: int, batch: int) -> bool:
    return total > excluded + batch


def cards(chosen: DataFrame, contacts: DataFrame, most: int = CARD_CONTACTS) -> DataFrame:
    """``chosen`` with the first contacts of each company by type and id, as an array of structs."""
    listed = contacts.filter(F.col("entity_type").isin(CARD_TYPES)).join(chosen.select("domain").distinct(), "domain", "left_semi")
    rank = F.row_number().over(Window.partitionBy("domain").orderBy("entity_type", "id"))
    top = listed.withColumn("rn", rank).filter(F.col("rn") <= most)
    item = F.struct("rn", "entity_type", "value", "label")
    nested = top.groupBy("domain").agg(F.sort_array(F.collect_list(item)).alias("items"))
    nested = nested.select("domain", F.transform("items", lambda x: F.struct(x["entity_type"].alias("entity_type"), x["value"].alias("value"), x["label"].alias("label"))).alias("top_contacts"))
    return chosen.join(nested, "domain", "left").withColumn("has_employees", F.col("emp_count") > 0)


def search(metadata: DataFrame, contacts: DataFrame, filters: Filters, keyword: str | None = None, employees: DataFrame | None = None) -> DataFrame:
    """One row per company and contact; companies without contacts too, unless contact types are asked for."""
    base = metadata.filter(F.col("status_code") == 200)
    if keyword:
        base = base.filter(has_text("title", keyword) | has_text("description", keyword) | has_text("domain", keyword))
    wanted = Filters(category=filters.category, location_contains=filters.location_contains, has_employees=filters.has_employees)
    base = wanted.apply(base, contacts, employees).select("domain", "category", "title", "location")
    right = contacts.select("domain", F.col("entity_type").alias("contact_type"), F.col("value").alias("contact_value"), F.col("label").alias("contact_label"))
    if filters.contact_type:
        return base.join(right.filter(F.col("contact_type").isin(filters.contact_type)), "domain")
    return base.join(right, "domain", "left")


def filter_query(metadata: DataFrame, crawl: DataFrame, filters: Filters, contacts: DataFrame | None = None) -> DataFrame:
    """Structured company query with the crawl's outcome beside it."""
    found = filters.apply(metadata, contacts).join(crawl.select("domain", "contacts_found", "crawled_at"), "domain", "left")
    return found.select("domain", "category", "status_code", "title", "description", "language", "location", "redirected_url", "fetch_ms", "contacts_found", "crawled_at")


def profile(domain: str, metadata: DataFrame, crawl: DataFrame, contacts: DataFrame, employees: DataFrame) -> DataFrame:
    """A company with its contacts and people nested, in the order of type and id."""
    key = domain.lower().strip()
    one = metadata.filter(F.col("domain") == key).orderBy(F.col("fetched_at").desc_nulls_last()).limit(1)
    status = crawl.filter(F.col("domain") == key).orderBy(F.col("crawled_at").desc_nulls_last()).limit(1).select("domain", "pages_crawled", "contacts_found", "crawled_at")
    listed = contacts.filter(F.col("domain") == key).groupBy("domain").agg(F.sort_array(F.collect_list(F.struct("entity_type", "id", "value", "label", "page_url"))).alias("contacts"))
    people = employees.filter(F.col("domain") == key).groupBy("domain").agg(F.sort_array(F.collect_list(F.struct("id", "name", "title", "email", "phone", "linkedin"))).alias("employees"))
    return one.join(status, "domain", "left").join(listed, "domain", "left").join(people, "domain", "left")
