"""Keyword categories of domain names, as higher-order expressions.

The keyword lists are a parameter: ``read_lists`` takes them from a file, ``STARTER`` is a short list to begin with.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A short list for tests and first runs; a deployment passes its own.
STARTER: dict[str, list[str]] = {
    "commodity": ["agri", "agro", "grain", "grains", "spice", "spices", "food", "metal", "metals", "steel", "rice", "cotton", "coffee", "oil", "textile", "chemical"],
    "exim": ["import", "export", "exporter", "importer", "exim", "trade", "trader", "trading", "customs", "overseas"],
    "logistics": ["freight", "cargo", "shipping", "logistics", "logistic", "movers", "warehouse", "transport", "courier", "port"],
}
# Suffixes taken off before a name is split, longest first.
SUFFIX = r"\.(co\.in|co\.uk|com\.au|com\.br|co\.za|co\.nz|co\.jp|com|net|org|biz|info|io|ai|tech|dev|co|in|us|uk|au|ca|de|fr|jp|br|ru|cn|nz|eu)$"


def read_lists(lines: Iterable[str]) -> dict[str, list[str]]:
    """Keyword lists from lines ``category: word, word``; several lines of a category add up, ``#`` starts a remark. The order of the categories decides ties."""
    out: dict[str, list[str]] = {}
    for line in lines:
        name, sep, words = line.split("#", 1)[0].partition(":")
        if sep:
            known = out.setdefault(name.strip().lower(), [])
            known += [w for w in dict.fromkeys(x.strip().lower() for x in words.split(",")) if w and w not in known]
    return out


def name_tokens(domain: str | Column, lists: dict[str, list[str]] = STARTER) -> Column:
    """Words of a domain name and the keywords inside its long words, without doubles, three letters or more."""
    d = F.col(domain) if isinstance(domain, str) else domain
    words = F.regexp_replace(F.lower(F.trim(d)), SUFFIX, "")
    raw = F.split(F.regexp_replace(words, r"^www\.", ""), "[^a-z0-9]+")
    every = F.array(*[F.lit(k) for k in sorted({k for ks in lists.values() for k in ks if len(k) >= 3})])
    inside = F.flatten(F.transform(F.filter(raw, lambda t: F.length(t) > 5), lambda t: F.filter(every, lambda k: F.contains(t, k) & (k != t))))
    return F.filter(F.array_distinct(F.concat(raw, inside)), lambda t: F.length(t) >= 3)


def category(domain: str | Column, lists: dict[str, list[str]] = STARTER) -> Column:
    """The category with the most keywords; ties go to the list given first, no keyword to null."""
    tokens = name_tokens(domain, lists)
    scores = {name: F.size(F.array_intersect(tokens, F.array(*[F.lit(k) for k in ks]))) for name, ks in lists.items()}
    best = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    out = F.when(best == 0, F.lit(None).cast("string"))
    for name, score in scores.items():
        out = out.when(score == best, name)
    return out
