"""Queries over literal rows: functions of addresses, pages and sources whose cases the tables don't hold.

Each row holds an input and what a function makes of it; the SQL has the results worked out by hand.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import contacts as contact_fn
from quarryline.functions import domains as domain_fn
from quarryline.functions import fulltext, html
from quarryline.functions.categories import category, name_tokens, read_lists
from quarryline.operators import maintenance, scoring
from quarryline.session import shared_folder
from quarryline.sources import ingest, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _sql(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values_sql(columns: list[str], rows: list[tuple], kinds: dict[str, str] | None = None) -> str:
    """Rows as SQL; ``kinds`` casts columns."""
    body = ", ".join("(" + ", ".join(_sql(v) for v in r) + ")" for r in rows)
    picked = ", ".join(f"CAST({c} AS {(kinds or {}).get(c, 'VARCHAR')}) AS {c}" for c in columns)
    return f"SELECT {picked} FROM (VALUES {body}) AS v({', '.join(columns)})"


def vectors(name: str, fn: Callable[[str], Column], cases: list[tuple[str | None, object]], kind: str = "VARCHAR") -> None:
    """A query of one function of a text."""
    QUERIES[name] = lambda spark, folder: spark.createDataFrame([(c[0],) for c in cases], "given string").select("given", fn("given").alias("made"))
    ORACLE[name] = values_sql(["given", "made"], cases, {"made": kind})


def table(name: str, columns: list[str], rows: list[tuple], kinds: dict[str, str] | None = None):
    """A query whose rows are worked out by hand."""

    def register(fn: Callable[[SparkSession], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(spark)
        ORACLE[name] = values_sql(columns, rows, kinds)
        return fn

    return register


vectors("tld_of_names", domain_fn.tld, [("acme.com.au", ".com.au"), ("acme.co.uk", ".co.uk"), ("acme.co.in", ".co.in"), ("acme.co.nz", ".co.nz"), ("acme.co.jp", ".co.jp"), ("acme.com.br", ".br"), ("acme.co.za", ".za"), ("acme.net", ".net"), ("acme", ""), (None, None)])
vectors(
    "certificate_roots", domain_fn.certificate_root,
    [("*.shop.acme.co.uk", "acme.co.uk"), ("10.0.0.1", None), ("mail.example.xyz", None), ("www.Acme.com", "acme.com"), ("https://www.acme.de/x", "acme.de"), ("a.b.acme.com.br", "acme.com.br"), ("x.github.io", "github.io"), ("x.y.pages.dev", "pages.dev"), ("localhost", None),
     ("acme.ae", "acme.ae"), ("a.co", "a.co"), ("a.b", None), ("shop.acme.co.xyz", None), ("x" * 250 + ".com", None), (None, None)],
)
vectors("site_domains", domain_fn.site_domain, [("https://www.Acme.com/x", "acme.com"), ("https://a.github.io/", None), ("https://x.xyz/", None), ("http://mail.acme.co.uk:8080/a?b", "mail.acme.co.uk"), (None, None)])
vectors("people_pages", domain_fn.lists_people, [("https://a.com/team", True), ("https://a.com/our-team/x", True), ("https://a.com/teams", False), ("https://a.com/blog", False), ("https://a.com/impressum", True), ("https://a.com/enquiry", True), ("https://a.com/", False)], "BOOLEAN")
vectors("zone_names", domain_fn.zone_domain, [("Acme.COM. 3600 in ns a.b.", "acme.com"), ("a.b", None), ("com 1 in ns x", None), ("\tx.org\t1", "x.org")])
vectors("usable_emails", contact_fn.is_usable_email, [("jo@acme.com", True), ("test@acme.com", False), ("wpcf7@acme.com", False), ("sentry@acme.com", False), ("dummy@acme.com", False), ("yourname@acme.com", False), ("your@acme.com", True), ("x@2x.png", False), ("x@a.woff", False), ("noreply@acme.com", False)], "BOOLEAN")
vectors("joined_emails", lambda c: F.array_join(contact_fn.spaced_emails(c), " "), [("Write JO @ acme.com now", "jo@acme.com"), ("a@b.com and c @d.org", "a@b.com c@d.org"), ("none @ all", ""), (None, None)])
vectors("hidden_emails", contact_fn.decode_hidden_email, [("".join(f"{b:02x}" for b in [0x42, *[ord(c) ^ 0x42 for c in "jo@acme.com"]]), "jo@acme.com"), ("", ""), (None, None)])
vectors("phone_forms", contact_fn.clean_phone, [("1234567", None), ("+1234567", "+1234567"), ("11111111", None), (" 020 7946 0018 ", "020 7946 0018"), ("1234567890123456", None), ("12121212", None), (None, None)])
vectors("phones_in_text", lambda c: F.array_join(contact_fn.phone_candidates(c), "|"), [("call +44 20 7946 0018 or (020) 7946-0019.", "+44 20 7946 0018|(020) 7946-0019"), ("ISO 9001, 12 May 2024", "")])
vectors(
    "profile_links", contact_fn.social_kind,
    [("https://www.linkedin.com/company/acme", "linkedin_company"), ("https://linkedin.com/in/jo", "linkedin_profile"), ("https://linkedin.com/pub/jo", "linkedin_profile"), ("https://x.com/acme", "twitter"), ("http://twitter.com/acme", "twitter"), ("https://facebook.com/acme", "facebook"),
     ("https://www.instagram.com/acme", "instagram"), ("https://youtube.com/c/acme", "youtube"), ("https://youtube.com/watch", None), ("https://api.whatsapp.com/send?phone=1", "whatsapp"), ("https://acme.com/linkedin.com/in/x", None), ("https://linkedin.com/", None)],
)
vectors(
    "stems", lambda c: F.array_join(fulltext.positions(c), " "),
    [("running shipped shipping", "run ship ship"), ("consigned consignment consistency", "consign consign consist"), ("companies spices exporters", "compani spice export"), ("skies dying news herring", "sky die news herring"), ("generously generate", "generous generat"), ("hoping hopping agreed", "hope hop agre"),
     ("relational conditional rational", "relat condit ration"), ("the cat of it", " cat  "), (None, "")],
)
vectors("score_classes", lambda c: scoring.quality_class(F.length(c)), [("x" * 60, "high"), ("x" * 59, "medium"), ("x" * 30, "medium"), ("x" * 29, "low")])
vectors("short_numbers", lambda c: scoring.short_number(F.col(c).cast("long")), [("1200000", "1.2M"), ("3000", "3K"), ("950", "950")])

LISTS = read_lists(["commodity: agri, rice  # fields", "exim: export, import", "logistics: port, freight", "exim: trade, export"])
vectors("listed_categories", lambda c: category(c, LISTS), [("agri-exports.co.in", "commodity"), ("bestimport.com", "exim"), ("www.freightport.com", "logistics"), ("xyz.com", None)])
vectors("name_words", lambda c: F.array_join(F.array_sort(name_tokens(c, LISTS)), " "), [("www.freightport.com", "freight freightport port"), ("my-rice.co.uk", "rice")])


PHRASES = [("steel pipes and rods", True), ("pipes of steel", False), ("steel, pipes", True), ("Steel pipe", True), (None, False)]
vectors("phrases", lambda c: fulltext.match(fulltext.positions(c), '"steel pipes"'), PHRASES, "BOOLEAN")
GAPS = [("bills of lading here", True), ("bills lading", False), ("bills with lading", True)]
vectors("phrases_over_stop_words", lambda c: fulltext.match(fulltext.positions(c), '"bill of lading"'), GAPS, "BOOLEAN")


# ---- pages ---------------------------------------------------------------------------------------------------------

HEAD = """<html lang="en-GB"><head><title>A &amp; B</title><meta content="hi" name="Description"><meta name="geo.placename" content="Torlipur"></head><body lang="fr">x</body>"""
OPEN_GRAPH = """<head><meta property="og:description" content="og"><meta http-equiv="content-language" content="de"></head>"""
TEAM = """<html><body><a href="mailto:Jo@Acme.com?x">Jo</a> <div class="team-member"><h3>Ann Lee</h3><p>Sales Manager</p><a href="/team/ann">more</a></div>
<div class="card"><h3>Bo Chan</h3><h4>Chief Officer</h4> bo.chan (at) acme (dot) com <a href="tel:+44 20 7946 0018">call</a></div>
<div class="card"><h3>Our Depot</h3><p>Lead, warehouse</p></div><div class="card"><h3>Port City Branch</h3><p>Agent</p></div>
<li class="staff"><b>Jo Silva</b> <span>Partner</span> <a href="https://www.linkedin.com/in/jo-silva">in</a></li>
<a href="/contact-us">c</a> <a href="/blog">b</a> <a href="about?x=1">a</a> <a href="https://other.com/team">o</a> <a href="/contact-us">again</a>
suesan at acme dot com, sue @ acme.com, meet at noon dot then, &#105;nfo&#64;acme.com <img alt="pat@acme.com logo@2x.png"> <script>x@y.com</script> test@acme.com
<a href="/cdn-cgi/l/email-protection" data-cfemail="4238272d02232f2f276c212d2f">hidden</a> <a href="https://x.com/acme" aria-label="X"></a>
<footer>Our office: 12 Long Street, Big Town <a href="tel:02012345678">t</a></footer></body></html>"""


def _pages(spark: SparkSession, *pages: tuple[str | None, str | None]) -> DataFrame:
    return spark.createDataFrame(list(pages), "html string, url string")


@table("page_heads", ["title", "description", "language", "location"], [("A & B", "hi", "en-GB", "Torlipur"), (None, "og", "de", None), (None, None, None, None)])
def _heads(spark):
    return html.with_head(_pages(spark, (HEAD, "a"), (OPEN_GRAPH, "b"), (None, "c"))).select("title", "description", "language", "location")


TEAM_EMAILS = [("jo@acme.com", "mailto"), ("zeo@amme.com", "hidden"), ("info@acme.com", "source"), ("pat@acme.com", "source"), ("bo.chan@acme.com", "spelt"), ("suesan@acme.com", "spelt"), ("sue@acme.com", "spaced")]


@table("page_emails", ["value", "context"], TEAM_EMAILS)
def _emails(spark):
    page = html.with_page(_pages(spark, (TEAM, "https://acme.com/team/")))
    return page.select(F.explode("contacts").alias("c")).filter("c.entity_type = 'email'").select("c.value", "c.context")


@table("page_contacts", ["entity_type", "value", "label", "context"], [("phone", "+44 20 7946 0018", None, "tel"), ("phone", "02012345678", None, "tel"), ("linkedin_profile", "https://www.linkedin.com/in/jo-silva", "in", None), ("twitter", "https://x.com/acme", "X", None)])
def _contacts(spark):
    page = html.with_page(_pages(spark, (TEAM, "https://acme.com/team/")))
    return page.select(F.explode("contacts").alias("c")).filter("c.entity_type <> 'email'").select("c.*")


@table("page_links", ["pos", "url"], [(0, "https://acme.com/contact-us"), (1, "https://acme.com/team/ann"), (2, "https://acme.com/team/about?x=1")], {"pos": "INTEGER"})
def _links(spark):
    return html.with_page(_pages(spark, (TEAM, "https://acme.com/team/"))).select(F.posexplode("links").alias("pos", "url"))


@table("ranked_links", ["pos", "url", "score"], [(0, "https://a.com/contact-us", 12), (1, "https://a.com/team", 9)], {"pos": "INTEGER", "score": "INTEGER"})
def _ranked(spark):
    df = spark.createDataFrame([(["https://a.com/blog", "https://a.com/team", "https://a.com/contact-us", "https://a.com/team", "https://a.com/about"],)], "links array<string>")
    return df.select(F.posexplode(domain_fn.ranked_links(F.col("links"), 2)).alias("pos", "x")).select("pos", "x.url", "x.score")


@table(
    "page_people", ["name", "title", "email", "phone", "linkedin"],
    [("Ann Lee", "Sales Manager", None, None, None), ("Bo Chan", "Chief Officer", "bo.chan@acme.com", "+44 20 7946 0018", None), ("Jo Silva", "Partner", "jo@acme.com", None, "https://www.linkedin.com/in/jo-silva")],
)
def _people(spark):
    return html.with_page(_pages(spark, (TEAM, "https://acme.com/team/"), (TEAM, "https://acme.com/blog"))).select(F.explode("people").alias("p")).select("p.*")


@table("page_profiles", ["name", "url"], [("Ann Lee", "https://acme.com/team/ann")])
def _profiles(spark):
    return html.with_page(_pages(spark, (TEAM, "https://acme.com/team/"))).select(F.explode("profiles").alias("p")).select("p.*")


@table("page_address", ["url", "address"], [("https://acme.com/team/", "Our office: 12 Long Street, Big Town t"), ("u", "1 Road"), ("v", None)])
def _address(spark):
    return html.with_page(_pages(spark, (TEAM, "https://acme.com/team/"), ("<address>1 <b>Road</b></address><p>Location</p>", "u"), (None, "v"))).select("url", "address")


@table("profile_backfill", ["name", "email", "phone"], [("Ann Lee", "ann@acme.com", "020 1234 5678"), ("Bo Chan", "bo@acme.com", "020 1234 9999"), ("Cy Roe", None, None)])
def _backfill(spark):
    people = spark.createDataFrame([("acme.com", "Ann Lee", None, None), ("acme.com", "Bo Chan", "bo@acme.com", None), ("acme.com", "Cy Roe", None, None)], "domain string, name string, email string, phone string")
    pages = [("acme.com", "ann lee", "<p>ann [at] acme [dot] com or 020 1234 5678"), ("acme.com", "Bo Chan", "<a href='mailto:other@acme.com'>x</a> 020 1234 9999"), ("acme.com", "Cy Roe", "<a href='mailto:cy@else.org'>x</a>")]
    return html.fill_from_profiles(people, spark.createDataFrame(pages, "domain string, name string, html string"))[0].drop("domain")


@table("bodies", ["page"], [("<body>x",), ("y",), ("z",)])
def _bodies(spark):
    return spark.createDataFrame([("<head>a</head><body>x",), ("<head>a</head >y",), ("z",)], "html string").select(html.without_head("html").alias("page"))


# ---- sources and sinks -----------------------------------------------------------------------------------------------

INDEX = ['com,acme)/ 20250101 {"url": "https://www.acme.com/a", "status": "200", "mime": "text/html"}', 'com,acme)/ 20240101 {"url": "http://acme.com/", "status": "200", "mime": ""}', 'x 1 {"url": "https://b.com", "status": "404"}', "bad",
         'x 2 {"url": "https://c.com/", "status": "200"}', 'x 3 {"url": "https://d.com/", "status": "200", "mime": "image/png"}', 'x 4 {"url": "https://e.xyz/", "status": "200"}']


@table("index_lines", ["domain", "last_crawled", "shard"], [("acme.com", "20240101", "s1"), ("c.com", "2", "s1")])
def _index(spark):
    return ingest.crawl_index(spark.createDataFrame([(x,) for x in INDEX], "value string"), "s1")


CERTIFICATES = '[{"name_value": "*.a.acme.com\\nb.org", "not_before": "2025"}, {"name_value": "10.0.0.1"}, {"name_value": "acme.com"}, {"name_value": null}, {"x": 1}]'


@table("certificate_lists", ["domain"], [("acme.com",), ("b.org",)])
def _certificates(spark):
    folder = f"{shared_folder(spark)}/certificates-{uuid.uuid4().hex}"
    spark.createDataFrame([(CERTIFICATES,)], "value string").coalesce(1).write.text(folder)
    return ingest.certificates(spark, folder)


@table("zone_lines", ["domain"], [("acme.com",), ("b.org",)])
def _zone(spark):
    return ingest.zone(spark.createDataFrame([("Acme.com. 1 in ns x",), ("acme.com 2",), ("b.org.\t3",), ("com. 1",), ("",)], "value string"))


@table("parameter_arrays", ["pos", "domain", "score"], [(0, "a.com", 3), (1, "b.com", None), (2, None, 5)], {"pos": "INTEGER", "score": "BIGINT"})
def _arrays(spark):
    return ingest.from_arrays(spark, domain=["a.com", "b.com"], score=[3, None, 5])


LOG = [("a.com", 1, None, 200, "text/html", "A"), ("b.com", 1, None, 503, "text/html", "no"), ("b.com", 2, None, 200, "text/html", "B"), ("c.com", 1, "ssl", None, None, None), ("c.com", 2, None, 200, "image/png", "x"), ("d.com", 1, "dns", None, None, None), ("e.com", 1, "odd", None, None, None), ("f.com", 1, None, 404, "text/html", "gone")]


@table("fetch_outcomes", ["domain", "status_code", "title", "error_msg"], [("a.com", 200, "A", None), ("b.com", 200, "B", None), ("c.com", 200, None, None), ("d.com", -2, None, "dns"), ("e.com", -6, None, "odd"), ("f.com", 404, None, None)], {"status_code": "INTEGER"})
def _outcomes(spark):
    return ingest.fetch_outcome(spark.createDataFrame(LOG, "domain string, try int, failure string, http_status int, content_type string, title string"))


@table("bad_rows", ["domain", "n", "bad"], [("a.com", 1, False), (None, None, True), (None, None, True)], {"n": "INTEGER", "bad": "BOOLEAN"})
def _bad(spark):
    rows = spark.createDataFrame([('{"domain": "a.com", "n": 1}',), ('{"domain": ',), ('{"n": 2}',)], "value string")
    good, bad = maintenance.split_bad(rows, "domain string, n int", "domain")
    return good.withColumn("bad", F.lit(False)).unionByName(bad.select(F.lit(None).cast("string").alias("domain"), F.lit(None).cast("int").alias("n"), F.lit(True).alias("bad")))


@table("saved_lines", ["value"], [("d,\"say 'x'\",,3",), ('e,"",exim,',)])
def _saved(spark):
    return sinks.saved_lines(spark.createDataFrame([('say "x"', "d", None, 3), (None, "e", "exim", None)], "title string, domain string, category string, quality_score int"))
