"""E-mail addresses, phone numbers and profile links as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarryline.functions.domains import root_domain

EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
SPACES_AROUND_AT = r"(?<=[\w.%+\-])\s*@\s*(?=[a-zA-Z0-9])"
UNSEEN = "[​‌‍‎‏﻿­]"
# Local parts that are no person's.
GENERIC = ["info", "sales", "contact", "support", "admin", "hello", "hi", "enquiries", "webmaster", "careers", "jobs", "media", "team"]
# Hosts of personal mailboxes.
PERSONAL = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "icloud.com", "me.com", "mac.com", "protonmail.com", "proton.me", "aol.com", "zoho.com"]
# Local parts that are placeholders, and endings of files that look like addresses.
PLACEHOLDERS = ["example", "test", "dummy", "sample", "noreply", "no-reply", "sentry", "wpcf7", "yourname", "username"]
ASSETS = ["png", "jpg", "gif", "svg", "css", "js", "woff"]
#: The hosts of each network; the kinds are told in this order.
SOCIAL_HOSTS: dict[str, list[str]] = {"linkedin": ["linkedin.com"], "twitter": ["twitter.com", "x.com"], "facebook": ["facebook.com"], "instagram": ["instagram.com"], "youtube": ["youtube.com"], "whatsapp": ["whatsapp.com"]}
#: What must follow the host for a link to be a profile.
SOCIAL_PATHS: dict[str, list[tuple[str, str]]] = {
    "linkedin": [("linkedin_company", r"company/[^\s\"'<>]"), ("linkedin_profile", r"(?:in|pub)/[^\s\"'<>]")], "twitter": [("twitter", r"\w")], "facebook": [("facebook", r"[^\s\"'<>]")],
    "instagram": [("instagram", r"[^\s\"'<>]")], "youtube": [("youtube", r"(?:c|channel|user)/[^\s\"'<>]")], "whatsapp": [("whatsapp", "send")],
}


def social_patterns(hosts: dict[str, list[str]] = SOCIAL_HOSTS, paths: dict[str, list[tuple[str, str]]] = SOCIAL_PATHS) -> list[tuple[str, str]]:
    """Each kind of profile with the pattern of its links, in order."""
    out = []
    for network, names in hosts.items():
        host = "|".join(re.escape(n) for n in names)
        prefix = "(?:api\\.)?" if network == "whatsapp" else "(?:www\\.)?"
        out += [(kind, f"(?i)^https?://{prefix}(?:{host})/{path}") for kind, path in paths[network]]
    return out


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def visible(text: str | Column) -> Column:
    """``text`` without characters that can't be seen."""
    return F.regexp_replace(_col(text), UNSEEN, "")


def emails(text: str | Column) -> Column:
    """The addresses in a text, lowered, in order, without doubles."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_col(text), F.lit("(" + EMAIL + ")"), 1), F.lower))


def spaced_emails(text: str | Column) -> Column:
    """Addresses, those with spaces around the sign closed up."""
    return emails(F.regexp_replace(_col(text), SPACES_AROUND_AT, "@"))


def is_usable_email(email: str | Column) -> Column:
    """No placeholder before the sign and no file name."""
    e = F.lower(_col(email))
    return ~e.rlike("(?:" + "|".join(PLACEHOLDERS) + ")@") & ~e.rlike(r"\.(?:" + "|".join(ASSETS) + ")$") & (F.length(F.element_at(F.split(e, r"\."), -1)) >= 2)


def decode_hidden_email(code: str | Column) -> Column:
    """An address hidden as hex: each byte is combined with the first one."""
    c = _col(code)
    byte = lambda i: F.conv(F.substr(c, i, F.lit(2)), 16, 10).cast("int")
    key = byte(F.lit(1))
    places = F.when(F.length(c) >= 4, F.sequence(F.lit(3), F.length(c) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.when(c.isNotNull(), F.array_join(F.transform(places, lambda i: F.char(byte(i).bitwiseXOR(key))), ""))


def is_employee_email(email: str | Column, domain: str | Column) -> Column:
    """A personal local part, of the firm's own domain or of a mailbox provider."""
    e = _col(email)
    local, at = F.element_at(F.split(e, "@"), 1), F.element_at(F.split(e, "@"), -1)
    root = root_domain(at)
    return F.contains(e, F.lit("@")) & ~F.lower(local).isin(GENERIC) & ((root == root_domain(domain)) | root.isin(PERSONAL))


def clean_phone(raw: str | Column) -> Column:
    """A number as written, if its digits can be one; else null."""
    r = F.trim(_col(raw))
    digits = F.regexp_replace(r, r"\D", "")
    n = F.length(digits)
    distinct = F.size(F.array_distinct(F.filter(F.split(digits, ""), lambda x: x != "")))
    ok = (n >= 7) & (n <= 15) & ~digits.rlike(r"^(\d)\1{6,}$") & (distinct >= 3) & ((n >= 8) | F.startswith(r, F.lit("+")))
    return F.when(ok, r)


#: Seven to fifteen digits, a plus sign before them perhaps, and at most two signs or spaces between two of them.
PHONE = r"(?<![\d.])\+?\(?\d(?:[\s().\-/]{0,2}\d){6,14}(?![\d])"


def phone_candidates(text: str | Column) -> Column:
    """Runs of digits that can be phone numbers. Numbering plans are not consulted; ``clean_phone`` is the check."""
    found = F.regexp_extract_all(_col(text), F.lit("(" + PHONE + ")"), 1)
    return F.array_distinct(F.filter(F.transform(found, clean_phone), lambda x: x.isNotNull()))


def social_kind(link: str | Column, hosts: dict[str, list[str]] = SOCIAL_HOSTS, paths: dict[str, list[tuple[str, str]]] = SOCIAL_PATHS) -> Column:
    """The kind of profile a link leads to, the first that fits."""
    out = None
    for kind, pattern in social_patterns(hosts, paths):
        hit = _col(link).rlike(pattern)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out
