"""Host names and addresses as column expressions; nothing leaves the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Top-level domains a corpus admits.
ALLOWED_TLDS = [".com", ".org", ".net", ".info", ".biz", ".io", ".ai", ".tech", ".dev", ".co", ".in", ".us", ".uk", ".ca", ".au", ".de", ".fr", ".jp", ".br", ".ru", ".cn", ".nz", ".eu"]
# Hosting services whose subdomains are no firms' domains.
BLOCKED_SUFFIXES = [
    ".vercel.app", ".netlify.app", ".netlify.com", ".onrender.com", ".render.com", ".herokuapp.com", ".github.io", ".gitlab.io", ".bitbucket.io", ".pages.dev", ".web.app", ".firebaseapp.com",
    ".azurewebsites.net", ".azurestaticapps.net", ".amplifyapp.com", ".surge.sh", ".fly.dev", ".railway.app", ".replit.app", ".repl.co", ".glitch.me", ".pythonanywhere.com", ".blogspot.com",
    ".blogspot.in", ".wordpress.com", ".wixsite.com", ".wix.com", ".squarespace.com", ".weebly.com", ".carrd.co", ".webflow.io", ".bubble.io", ".framer.app", ".framer.website", ".myshopify.com", ".substack.com",
]
# Second labels under which firms register.
SECOND_LEVEL = ["co", "com", "org", "net", "edu", "gov"]
# The lists of the certificate source.
CERTIFICATE_TLDS = [".com", ".org", ".net", ".info", ".biz", ".io", ".ai", ".tech", ".dev", ".co", ".in", ".us", ".uk", ".ca", ".au", ".de", ".fr", ".sg", ".ae", ".cn", ".jp", ".br", ".mx", ".za", ".nz", ".eu"]
CERTIFICATE_TWO_LEVEL = [".co.in", ".com.au", ".co.uk", ".com.br", ".co.za", ".co.nz", ".co.jp"]
CERTIFICATE_BLOCKED = [
    ".vercel.app", ".netlify.app", ".netlify.com", ".onrender.com", ".render.com", ".herokuapp.com", ".github.io", ".gitlab.io", ".bitbucket.io", ".pages.dev", ".web.app", ".firebaseapp.com", ".azurewebsites.net", ".azurestaticapps.net",
    ".amplifyapp.com", ".surge.sh", ".fly.dev", ".railway.app", ".replit.app", ".repl.co", ".glitch.me", ".pythonanywhere.com", ".blogspot.com", ".wordpress.com", ".wixsite.com", ".squarespace.com", ".weebly.com", ".webflow.io",
    ".bubble.io", ".myshopify.com", ".substack.com", ".carrd.co",
]
# Two-level endings a histogram of top-level domains tells apart.
TWO_LEVEL = [".com.au", ".co.uk", ".co.in", ".co.nz", ".co.jp"]
# Path patterns in their order, with the priority of the page.
PAGE_PRIORITY = [
    ("contact[_\\-]?us", 12), ("contacts", 11), ("contact", 10), ("reach[_\\-]?us", 10), ("get[_\\-]?in[_\\-]?touch", 10), ("enquir", 9), ("inquir", 9), ("support", 7), ("our[_\\-]?team", 11),
    ("meet[_\\-]?the[_\\-]?team", 11), ("meet[_\\-]?us", 10), ("team[_\\-]?member", 10), ("\\bteam\\b", 9), ("\\bstaff\\b", 9), ("\\bpeople\\b", 8), ("employee", 8), ("about[_\\-]?us", 10), ("\\babout\\b", 8),
    ("who[_\\-]?we[_\\-]?are", 9), ("management", 8), ("leadership", 8), ("\\bboard\\b", 7), ("director", 7), ("executive", 7), ("founder", 7),
]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ends_with_any(c: Column, endings: list[str]) -> Column:
    return c.rlike("(?:" + "|".join(re.escape(e) for e in endings) + ")$")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def host(url: str | Column) -> Column:
    """The host of an address, lowered, without ``www.``; null for a malformed address."""
    return F.regexp_replace(F.lower(F.try_parse_url(_col(url), F.lit("HOST"))), r"^www\.", "")


def site_domain(url: str | Column) -> Column:
    """The host if a corpus admits it: longer than three, an allowed top-level domain, no hosting service."""
    return _let(host(url), lambda h: F.when((F.length(h) > 3) & _ends_with_any(h, ALLOWED_TLDS) & ~_ends_with_any(h, BLOCKED_SUFFIXES), h))


def root_domain(value: str | Column) -> Column:
    """The last two labels of a host or address, or three under a second-level suffix such as ``co.in``."""
    bare = F.element_at(F.split(F.element_at(F.split(_col(value), "://"), -1), "/"), 1)
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")
    second = F.element_at(labels, F.greatest(n - 1, F.lit(1)))
    return F.when((n > 2) & second.isin(SECOND_LEVEL), last(3)).when(n >= 2, last(2)).otherwise(bare)


def certificate_root(name: str | Column) -> Column:
    """The registrable domain of a certificate name; null for addresses, bare names, names too short or too long, endings a corpus doesn't admit and hosting services.

    Three labels are kept under a two-level ending, which is admitted whatever its last label.
    """
    bare = F.regexp_replace(F.lower(F.trim(_col(name))), r"^\*\.", "")
    host_part = F.regexp_extract(bare, r"^.*?://([^/?#]*)", 1)
    bare = F.regexp_replace(F.when(host_part != "", host_part).otherwise(bare), r"^www\.", "")

    def root(b: Column) -> Column:
        two, one = F.regexp_extract(b, r"((?:\.[^.]*){2})$", 1), F.regexp_extract(b, r"(\.[^.]*)$", 1)
        last_three, last_two = F.regexp_extract(b, r"([^.]*(?:\.[^.]*){2})$", 1), F.regexp_extract(b, r"([^.]*\.[^.]*)$", 1)
        ok = ~b.rlike(r"^\d+\.\d+\.\d+\.\d+$") & F.contains(b, F.lit(".")) & F.length(b).between(4, 253)
        kept = (last_three != "") & two.isin(CERTIFICATE_TWO_LEVEL) & ~_ends_with_any(last_three, CERTIFICATE_BLOCKED)
        admitted = one.isin(CERTIFICATE_TLDS) & (F.length(last_two) >= 4) & ~_ends_with_any(last_two, CERTIFICATE_BLOCKED)
        return F.when(ok & kept, last_three).when(ok & admitted, last_two)

    return _let(bare, root)


def zone_domain(line: str | Column) -> Column:
    """The owner of a zone-file line: first token, lowered, without its final dot; null if it is no domain."""
    token = F.regexp_replace(F.lower(F.element_at(F.split(F.regexp_replace(_col(line), r"^\s+", ""), r"\s+"), 1)), r"\.$", "")
    return F.when(F.contains(token, F.lit(".")) & (F.length(token) >= 4), token)


def tld(domain: str | Column) -> Column:
    """The top-level domain with its dot, two-level ones first."""
    d = _col(domain)
    two = F.regexp_extract(d, "(" + "|".join(t.replace(".", r"\.") for t in TWO_LEVEL) + ")$", 1)
    return F.when(two != "", two).otherwise(F.regexp_extract(d, r"(\.[^.]*)$", 1))


def url_score(url: str | Column) -> Column:
    """The priority of a page by its path: the first pattern that matches."""
    path = F.coalesce(F.try_parse_url(_col(url), F.lit("PATH")), F.lit(""))
    out = None
    for pattern, worth in PAGE_PRIORITY:
        hit = path.rlike("(?i)" + pattern)
        out = F.when(hit, worth) if out is None else out.when(hit, worth)
    return out.otherwise(0)


# Path parts of pages that list people.
PEOPLE_PATHS = [
    "team", "our[-_]?team", "meet[-_]?the[-_]?team", "meet[-_]?our[-_]?team", "team[-_]?members?", "staff", "our[-_]?staff", "people", "our[-_]?people", "about", "about[-_]?us", "about[-_]?the[-_]?company", "who[-_]?we[-_]?are",
    "company[-_]?profile", "contact", "contacts", "contact[-_]?us", "leadership", "our[-_]?leadership", "leadership[-_]?team", "management", "our[-_]?management", "management[-_]?team", "executives?", "executive[-_]?team", "founders?",
    "directors?", "board[-_]?of[-_]?directors?", "board", "partners?", "profile", "profiles", "bio", "bios", "biography", "member", "members", "experts?", "specialists?", "consultants?", "advisors?", "imprint", "impressum", "office",
    "offices", "locations?",
]
PEOPLE_SCORE = 8
_PEOPLE = "(?i)/(" + "|".join(PEOPLE_PATHS) + r")([/?#.\-]|$)"


def lists_people(url: str | Column) -> Column:
    """Whether a page is one that people are looked for on: by its path, or by its priority."""
    return F.coalesce(_col(url).rlike(_PEOPLE), F.lit(False)) | (url_score(url) >= PEOPLE_SCORE)


def ranked_links(links: Column, most: int | None = None) -> Column:
    """The links with a priority, best first, ties by address from the end of the alphabet; at most ``most``."""
    scored = F.filter(F.transform(F.array_distinct(links), lambda u: F.struct(url_score(u).alias("score"), u.alias("url"))), lambda x: x["score"] > 0)
    order = F.reverse(F.array_sort(scored))
    return F.slice(order, 1, most) if most is not None else order
