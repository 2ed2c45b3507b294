"""All queries of the core, by name, and the SQL each is held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import contacts as contact_fn
from quarryline.functions import domains as domain_fn
from quarryline.functions import fulltext
from quarryline.functions.categories import STARTER, category
from quarryline.operators import leads, maintenance, ranks, reports, scoring
from quarryline.plans import guard
from quarryline.session import shared_folder
from quarryline.sources import sinks
from quarryline.sources.tables import read_table
from quarryline.streaming import crawl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of a folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = {"meta": "domain_metadata", "contacts": "domain_contacts", "people": "domain_employees", "crawl": "domain_crawl_status"}.get(name, name)
        return read_table(self.spark, self.folder, table)


def query(sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


CARD = "domain, title, description, category, location, email_count, phone_count, linkedin_count, social_count, emp_count, quality_score"
ORDERED = "ORDER BY quality_score DESC, domain LIMIT"


# ---- serving ------------------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT {CARD} FROM domain_metadata WHERE status_code = 200 AND quality_score > 0 {ORDERED} 50")
def discover_topk(t):
    return leads.discover(t.meta, leads.Filters(), batch=50)


@query(f"SELECT DISTINCT {CARD} FROM domain_metadata WHERE status_code = 200 AND quality_score > 0 AND (contains(lower(title), 'freight') OR contains(lower(domain), 'freight') OR contains(lower(title), 'pepper')) {ORDERED} 50")
def discover_keyword(t):
    return leads.discover(t.meta, leads.Filters(), keyword="freight OR pepper", batch=50)


@query(f"""SELECT DISTINCT {CARD} FROM domain_metadata m WHERE status_code = 200 AND quality_score > 0 AND category IN ('logistics', 'exim')
    AND domain <> 'tradolane-hub.com.example' AND EXISTS (SELECT 1 FROM domain_contacts c WHERE c.domain = m.domain AND entity_type IN ('email', 'phone'))
    AND EXISTS (SELECT 1 FROM domain_employees e WHERE e.domain = m.domain) {ORDERED} 50""")
def discover_filtered(t):
    wanted = leads.Filters(category=["logistics", "exim"], contact_type=["email", "phone"], has_employees=True, excluded_domains=["tradolane-hub.com.example"])
    return leads.discover(t.meta, wanted, t.contacts, t.people, batch=50)


@query(f"SELECT DISTINCT {CARD} FROM domain_metadata WHERE status_code = 200 AND quality_score > 0 AND (location IS NULL OR NOT contains(lower(location), 'fereria')) {ORDERED} 50")
def exclude_country_nullable(t):
    return leads.discover(t.meta, leads.Filters(exclude_location="Fereria"), batch=50)


@query("SELECT count(*) AS total_matched, (SELECT count(*) FROM (SELECT 1 FROM domain_metadata WHERE status_code = 200 AND quality_score > 0 LIMIT 100)) AS capped FROM (SELECT 1 FROM domain_metadata WHERE status_code = 200 AND quality_score > 0 LIMIT 5000)")
def capped_count(t):
    found = t.meta.filter("status_code = 200 and quality_score > 0")
    return leads.capped_count(found).join(leads.capped_count(found, 100).withColumnRenamed("total_matched", "capped"), F.lit(True))


@query("""SELECT domain, rn, entity_type, value, label FROM (SELECT domain, entity_type, value, label,
    row_number() OVER (PARTITION BY domain ORDER BY entity_type, id) AS rn FROM domain_contacts
    WHERE entity_type IN ('email', 'phone', 'linkedin', 'facebook', 'instagram', 'twitter', 'youtube', 'whatsapp')
    AND domain IN (SELECT domain FROM (SELECT DISTINCT domain, quality_score FROM domain_metadata WHERE status_code = 200 AND quality_score > 0 ORDER BY quality_score DESC, domain LIMIT 50))) WHERE rn <= 30""")
def top_contacts_per_card(t):
    chosen = t.meta.filter("status_code = 200 and quality_score > 0").select("domain", "quality_score", "emp_count").distinct()
    chosen = chosen.groupBy("domain", "quality_score").agg(F.max("emp_count").alias("emp_count")).orderBy(F.col("quality_score").desc(), "domain").limit(50)
    nested = leads.cards(chosen, t.contacts).filter("top_contacts is not null")
    item = nested.select("domain", F.posexplode("top_contacts").alias("pos", "x"))
    return item.select("domain", (F.col("pos") + 1).cast("long").alias("rn"), "x.entity_type", "x.value", "x.label")


@query("""SELECT m.domain, m.category, m.title, m.location, c.entity_type AS contact_type, c.value AS contact_value, c.label AS contact_label
    FROM domain_metadata m JOIN domain_contacts c ON c.domain = m.domain AND c.entity_type IN ('email', 'phone')
    WHERE m.status_code = 200 AND m.category = 'logistics' AND (contains(lower(title), 'cargo') OR contains(lower(description), 'cargo') OR contains(lower(m.domain), 'cargo'))""")
def search_inner(t):
    return leads.search(t.meta, t.contacts, leads.Filters(category=["logistics"], contact_type=["email", "phone"]), "cargo")


@query("""SELECT m.domain, m.category, m.title, m.location, c.entity_type AS contact_type, c.value AS contact_value, c.label AS contact_label
    FROM domain_metadata m LEFT JOIN domain_contacts c ON c.domain = m.domain WHERE m.status_code = 200 AND contains(lower(m.location), 'tasoland')""")
def search_left(t):
    return leads.search(t.meta, t.contacts, leads.Filters(location_contains="tasoland"))


@query("""SELECT m.domain, m.category, m.title, m.location, c.entity_type AS contact_type, c.value AS contact_value, c.label AS contact_label
    FROM domain_metadata m LEFT JOIN domain_contacts c ON c.domain = m.domain WHERE m.status_code = 200
    ORDER BY m.domain, contact_type NULLS FIRST, contact_value NULLS FIRST, contact_label NULLS FIRST, m.title NULLS FIRST LIMIT 100 OFFSET 200""")
def search_page(t):
    order = [F.col(c).asc_nulls_first() for c in ("domain", "contact_type", "contact_value", "contact_label", "title")]
    return leads.page(leads.search(t.meta, t.contacts, leads.Filters()), order, 100, 200)


@query("SELECT count(DISTINCT m.domain) AS total_matched FROM domain_metadata m JOIN domain_contacts c ON c.domain = m.domain AND c.entity_type = 'email' WHERE m.status_code = 200")
def search_distinct_total(t):
    return leads.search(t.meta, t.contacts, leads.Filters(contact_type=["email"])).agg(F.countDistinct("domain").alias("total_matched"))


FILTER_COLUMNS = "m.domain, m.category, m.status_code, m.title, m.description, m.language, m.location, m.redirected_url, m.fetch_ms, s.contacts_found, s.crawled_at"


@query(f"""SELECT {FILTER_COLUMNS} FROM domain_metadata m LEFT JOIN domain_crawl_status s ON s.domain = m.domain
    WHERE m.category IN ('exim', 'commodity') AND m.status_code IN (200, 301) AND contains(lower(m.title), 'partner')
    AND EXISTS (SELECT 1 FROM domain_contacts c WHERE c.domain = m.domain)""")
def filter_query(t):
    return leads.filter_query(t.meta, t.crawl, leads.Filters(category=["exim", "commodity"], status_code=[200, 301], title_contains="partner", has_contacts=True), t.contacts)


@query("SELECT count(*) AS n FROM domain_metadata m WHERE contains(lower(description), 'quality') AND contains(lower(domain), 'agro')")
def filter_count(t):
    return leads.Filters(description_contains="quality", domain_contains="agro").apply(t.meta).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT domain, status_code, fetch_ms FROM domain_metadata m WHERE NOT EXISTS (SELECT 1 FROM domain_contacts c WHERE c.domain = m.domain)")
def no_contacts_anti(t):
    return leads.Filters(has_contacts=False).apply(t.meta, t.contacts).select("domain", "status_code", "fetch_ms")


@query("""SELECT domain, count(*) AS contact_rows, count(DISTINCT entity_type) AS kinds, (SELECT count(*) FROM domain_employees e WHERE e.domain = 'tradolane-hub.com.example') AS people
    FROM domain_contacts WHERE domain = 'tradolane-hub.com.example' GROUP BY domain""")
def profile_sizes(t):
    one = t.contacts.filter("domain = 'tradolane-hub.com.example'").groupBy("domain").agg(F.count(F.lit(1)).alias("contact_rows"), F.countDistinct("entity_type").alias("kinds"))
    people = t.people.filter("domain = 'tradolane-hub.com.example'").agg(F.count(F.lit(1)).alias("people"))
    return one.join(people, F.lit(True))


@query()
def profile(t):
    return leads.profile("tradolane-hub.com.example", t.meta, t.crawl, t.contacts, t.people)


@query("""SELECT 'category' AS kind, category AS value FROM domain_metadata WHERE category IS NOT NULL GROUP BY category
    UNION ALL SELECT 'language', language FROM (SELECT DISTINCT language FROM domain_metadata WHERE language IS NOT NULL AND status_code = 200 ORDER BY language LIMIT 50)
    UNION ALL SELECT 'contact_type', entity_type FROM domain_contacts GROUP BY entity_type""")
def filter_options(t):
    return reports.filter_options(t.meta, t.contacts)


@query("SELECT domain, title FROM domain_metadata WHERE title ILIKE '%sh_pping%'")
def wildcard_title(t):
    return t.meta.filter(leads.like_text("title", "sh_pping")).select("domain", "title")


@query("SELECT domain, title FROM domain_metadata WHERE list_contains(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}]+'), 'steel') AND NOT list_contains(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}]+'), 'freight')")
def fulltext_boolean(t):
    return t.meta.filter(fulltext.match(fulltext.lexemes("title", stemmed=False), "steel -freight", stemmed=False)).select("domain", "title")


@query("""SELECT domain, title FROM domain_metadata WHERE contains(' ' || array_to_string(list_filter(regexp_split_to_array(lower(concat_ws(' ', coalesce(title, ''), coalesce(description, ''))), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''), ' ') || ' ', ' steel pipes ')""")
def fulltext_phrase(t):
    return t.meta.filter(fulltext.match(fulltext.positions("title", "description", stemmed=False), '"steel pipes"', stemmed=False)).select("domain", "title")


@query()
def fulltext_stemmed(t):
    vector = fulltext.positions("title", "description", "domain", "location", "category")
    return t.meta.filter(fulltext.match(vector, 'shipping pepper or "steel pipes"')).select("domain", "title")


@query("""SELECT domain, fetch_ms, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''))), ' ') AS words,
    coalesce(search_vector = list_sort(list_distinct(list_filter(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''))), false) AS is_fresh FROM domain_metadata WHERE title IS NOT NULL""")
def derived_vectors(t):
    vector = fulltext.search_vector("title")
    return t.meta.filter("title is not null").select("domain", "fetch_ms", F.array_join(vector, " ").alias("words"), F.coalesce(F.col("search_vector") == vector, F.lit(False)).alias("is_fresh"))


# ---- scores and counts ---------------------------------------------------------------------------------------

SCORED = """SELECT m.domain, m.fetch_ms, coalesce(c.emails, 0) AS emails, coalesce(c.phones, 0) AS phones, coalesce(c.socials, 0) AS socials, coalesce(e.n, 0) AS people,
    (CASE WHEN coalesce(c.emails, 0) > 0 THEN 20 ELSE 0 END + CASE WHEN coalesce(c.phones, 0) > 0 THEN 15 ELSE 0 END + CASE WHEN coalesce(c.linkedins, 0) > 0 THEN 10 ELSE 0 END
     + CASE WHEN coalesce(c.socials, 0) > 0 THEN 5 ELSE 0 END + CASE WHEN coalesce(e.n, 0) > 0 THEN 15 ELSE 0 END + CASE WHEN m.description IS NOT NULL THEN 5 ELSE 0 END
     + CASE WHEN m.location IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN m.status_code = 200 THEN 10 ELSE 0 END
     + CASE WHEN coalesce(c.emails, 0) + coalesce(c.phones, 0) > 2 THEN 10 ELSE 0 END)::INTEGER AS score
    FROM domain_metadata m LEFT JOIN (SELECT domain, count(*) FILTER (entity_type = 'email') AS emails, count(*) FILTER (entity_type = 'phone') AS phones,
      count(*) FILTER (entity_type = 'linkedin') AS linkedins, count(*) FILTER (entity_type IN ('facebook', 'instagram', 'twitter', 'youtube', 'whatsapp')) AS socials FROM domain_contacts GROUP BY domain) c ON c.domain = m.domain
    LEFT JOIN (SELECT domain, count(*) AS n FROM domain_employees GROUP BY domain) e ON e.domain = m.domain"""


@query(SCORED.replace("emails,", "emails,", 1))
def quality_score(t):
    s = scoring.score(t.meta, t.contacts, t.people)
    return s.select("domain", "fetch_ms", F.col("email_count").cast("long").alias("emails"), F.col("phone_count").cast("long").alias("phones"), F.col("social_count").cast("long").alias("socials"), F.col("emp_count").cast("long").alias("people"), F.col("quality_score").alias("score"))


@query("SELECT CASE WHEN quality_score >= 60 THEN 'high' WHEN quality_score >= 30 THEN 'medium' ELSE 'low' END AS class, count(*) AS n FROM domain_metadata GROUP BY 1")
def quality_class(t):
    return t.meta.groupBy(scoring.quality_class().alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT domain, count(*) FILTER (entity_type = 'email') AS emails, count(*) FILTER (entity_type = 'phone') AS phones, count(*) FILTER (starts_with(entity_type, 'linkedin')) AS linkedins,
    count(*) FILTER (entity_type IN ('facebook', 'instagram', 'twitter', 'youtube', 'whatsapp')) AS socials FROM domain_contacts GROUP BY domain""")
def contact_counts(t):
    return scoring.contact_counts(t.contacts, linkedin_prefix=True)


# ---- work lists and writes -------------------------------------------------------------------------------------


@query("SELECT DISTINCT domain FROM domains d WHERE NOT EXISTS (SELECT 1 FROM domain_metadata m WHERE m.domain = d.domain)")
def worklist_anti(t):
    return maintenance.work_list(t.domains.select("domain").distinct(), t.meta)


@query("SELECT DISTINCT domain FROM domain_metadata m WHERE status_code = 200 AND domain > 'm' AND NOT EXISTS (SELECT 1 FROM domain_crawl_status s WHERE s.domain = m.domain) ORDER BY domain LIMIT 200")
def worklist_keyset(t):
    return maintenance.work_list(t.meta.filter("status_code = 200").select("domain").distinct(), t.crawl, after="m", batch=200)


@query("SELECT DISTINCT domain, (('0x' || substr(md5(domain), 1, 8))::BIGINT % 16) AS shard FROM domains WHERE ('0x' || substr(md5(domain), 1, 8))::BIGINT % 16 = 3")
def md5_shard(t):
    rows = t.domains.select("domain", maintenance.shard_of("domain", 16).alias("shard")).distinct()
    return rows.filter("shard = 3")


@query("""SELECT DISTINCT m.domain FROM domain_metadata m JOIN domain_crawl_status s ON s.domain = m.domain
    WHERE m.status_code = 200 AND s.contacts_found = 0 AND (s.error_msg IS NULL OR s.error_msg = '')""")
def second_pass_worklist(t):
    empty = t.crawl.filter((F.col("contacts_found") == 0) & leads.is_blank("error_msg")).select("domain")
    return t.meta.filter("status_code = 200").join(empty, "domain").select("domain").distinct()


@query("""SELECT (SELECT count(DISTINCT domain) FROM domains) AS total, count(*) AS pending FROM (SELECT DISTINCT domain FROM domains d WHERE NOT EXISTS (SELECT 1 FROM domain_crawl_status s WHERE s.domain = d.domain))""")
def pending_count(t):
    every = t.domains.select("domain").distinct()
    total = every.agg(F.count(F.lit(1)).alias("total"))
    return total.join(maintenance.work_list(every, t.crawl).agg(F.count(F.lit(1)).alias("pending")), F.lit(True))


@query("""SELECT id, domain, entity_type, value FROM domain_contacts WHERE id % 2 = 0 UNION ALL
    SELECT id, domain, entity_type, value FROM (SELECT *, row_number() OVER (PARTITION BY domain, entity_type, value ORDER BY id) AS rn FROM domain_contacts n WHERE id % 2 = 1) n
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM domain_contacts o WHERE o.id % 2 = 0 AND o.domain = n.domain AND o.entity_type = n.entity_type AND o.value = n.value)""")
def insert_ignore(t):
    rows = t.contacts.select("id", "domain", "entity_type", "value")  # every row arrives, the even ones first
    return maintenance.insert_ignore(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), ["domain", "entity_type", "value"], [F.col("id")])


LAST = "crawled_at DESC NULLS LAST, status_code DESC NULLS LAST, pages_crawled DESC NULLS LAST, contacts_found DESC NULLS LAST, error_msg DESC NULLS LAST, category DESC NULLS LAST"
CRAWL = "domain, status_code, pages_crawled, contacts_found, error_msg, crawled_at, category"


@query(f"""WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain, (coalesce(pages_crawled, 0) > 3) ORDER BY {LAST}) AS rn, coalesce(pages_crawled, 0) > 3 AS is_new FROM domain_crawl_status) WHERE rn = 1),
    old AS (SELECT * FROM last WHERE NOT is_new), new AS (SELECT * FROM last WHERE is_new)
    SELECT {CRAWL} FROM old WHERE domain NOT IN (SELECT domain FROM new) UNION ALL
    SELECT n.domain, n.status_code, n.pages_crawled, n.contacts_found, n.error_msg, n.crawled_at, CASE WHEN o.domain IS NULL THEN n.category ELSE o.category END FROM new n LEFT JOIN old o ON o.domain = n.domain""")
def upsert_last(t):
    rows = t.crawl.select(*CRAWL.split(", "))
    order = [F.col(c).desc_nulls_last() for c in ("crawled_at", "status_code", "pages_crawled", "contacts_found", "error_msg", "category")]
    late = F.coalesce("pages_crawled", F.lit(0)) > 3  # the rows of a second crawl, say
    return maintenance.upsert(maintenance.first_arrivals(rows.filter(~late), ["domain"], order), rows.filter(late), ["domain"], order, keep=["category"])


@query("""SELECT d.domain, d.last_crawled, d.shard, coalesce(d.category, m.category) AS category FROM domains d
    LEFT JOIN (SELECT domain, max(category) AS category FROM domain_metadata GROUP BY domain) m ON m.domain = d.domain""")
def coalesce_update(t):
    new = t.meta.groupBy("domain").agg(F.max("category").alias("category"))
    return maintenance.fill_missing(t.domains, new, "domain", "category")


@query("""SELECT d.domain, d.last_crawled, CASE WHEN m.domain IS NOT NULL THEN m.shard ELSE d.shard END AS shard, d.category FROM domains d
    LEFT JOIN (SELECT domain, 'retry' AS shard FROM domain_metadata WHERE status_code = -2 GROUP BY domain) m ON m.domain = d.domain""")
def keyed_overwrite(t):
    new = t.meta.filter("status_code = -2").select("domain", F.lit("retry").alias("shard")).distinct()
    return maintenance.overwrite(t.domains, new, "domain", ["shard"])


@query("""SELECT domain, status_code, error_msg FROM domain_crawl_status WHERE error_msg IS NULL OR error_msg = ''
    OR error_msg IN ('connection_failed_429', 'connection_failed_403', 'connection_failed_500', 'connection_failed_200', 'connection_failed_503', 'connection_failed_404', 'connection_failed_522', 'connection_failed_502', 'connection_failed_406', 'connection_failed_408')
    OR error_msg LIKE 'A child process terminated abruptly%'""")
def delete_transient(t):
    return maintenance.delete_transient(t.crawl).select("domain", "status_code", "error_msg")


# ---- reports -----------------------------------------------------------------------------------------------------


@query("""SELECT (SELECT count(*) FROM domain_metadata) AS total_rows, (SELECT count(DISTINCT domain) FROM domain_metadata) AS total_domains, (SELECT count(*) FROM domain_metadata WHERE status_code = 200) AS reachable,
    (SELECT count(*) FROM domain_contacts) AS total_contacts, (SELECT count(DISTINCT domain) FROM domain_contacts) AS domains_with_contacts, (SELECT count(*) FROM domain_employees) AS total_employees""")
def stats_overview(t):
    return reports.stats(t.meta, t.contacts, t.people)


@query("SELECT coalesce(category, 'uncategorized') AS category, count(*) AS cnt FROM domains GROUP BY 1")
def by_category(t):
    return reports.counts_by(t.domains, "category", "uncategorized")


@query("SELECT entity_type, count(*) AS cnt FROM domain_contacts GROUP BY 1")
def by_contact_type(t):
    return reports.counts_by(t.contacts, "entity_type")


@query("SELECT status_code, count(*) AS cnt, round(count(*)::DOUBLE * 100.0::DOUBLE / (SELECT count(*) FROM domain_metadata)::DOUBLE, 1) AS pct FROM domain_metadata GROUP BY 1")
def share_of_total(t):
    return reports.share_of_total(t.meta, "status_code")


@query("SELECT coalesce(error_msg, 'HTTP 200') AS error_msg, count(*) AS cnt FROM domain_crawl_status GROUP BY 1 ORDER BY cnt DESC, error_msg LIMIT 15")
def error_breakdown(t):
    return reports.counts_by(t.crawl, "error_msg", "HTTP 200").limit(15)


@query("""SELECT targets, crawled, with_contacts, empty, errors, CASE WHEN targets > 0 THEN crawled * 100 // targets ELSE 0 END::BIGINT AS crawled_pct, targets - crawled AS remaining,
    (with_contacts * 100 // crawled)::BIGINT AS success_pct, (empty * 100 // crawled)::BIGINT AS empty_pct, (errors * 100 // crawled)::BIGINT AS error_pct
    FROM (SELECT (SELECT count(*) FROM domain_metadata WHERE status_code = 200) AS targets, count(*) AS crawled, count(*) FILTER (contacts_found > 0) AS with_contacts,
    count(*) FILTER (contacts_found = 0 AND (error_msg IS NULL OR error_msg = '')) AS empty, count(*) FILTER (error_msg <> '') AS errors FROM domain_crawl_status)""")
def crawl_report(t):
    return reports.crawl_report(t.meta, t.crawl)


@query("SELECT CASE WHEN fetch_ms < 1000 THEN '<1s' WHEN fetch_ms < 5000 THEN '1-5s' WHEN fetch_ms < 12000 THEN '5-12s' ELSE '>12s' END AS bucket, count(*) AS cnt FROM domain_metadata WHERE fetch_ms IS NOT NULL GROUP BY 1")
def latency_buckets(t):
    return t.meta.filter("fetch_ms is not null").groupBy(reports.latency_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))


@query("""SELECT CASE WHEN status_code = 200 THEN 'success' WHEN status_code = -1 THEN 'timeout' WHEN status_code = -2 THEN 'dns_fail' WHEN status_code IN (-3, -6) THEN 'conn_error' WHEN status_code = -4 THEN 'ssl_error'
    WHEN contains(coalesce(error_msg, ''), 'connection_failed') THEN 'conn_error' ELSE 'other' END AS class, count(*) AS cnt FROM domain_crawl_status GROUP BY 1""")
def error_classes(t):
    return t.crawl.groupBy(reports.error_class().alias("class")).agg(F.count(F.lit(1)).alias("cnt"))


@query("SELECT id, domain, entity_type, value FROM domain_contacts ORDER BY id DESC LIMIT 10")
def latest_contacts(t):
    return reports.latest(t.contacts.select("id", "domain", "entity_type", "value"), "id")


@query("SELECT domain, fetch_ms, status_code, error_msg FROM domain_metadata ORDER BY fetch_ms DESC NULLS LAST, domain, status_code LIMIT 20")
def slowest_domains(t):
    return t.meta.select("domain", "fetch_ms", "status_code", "error_msg").orderBy(F.col("fetch_ms").desc_nulls_last(), "domain", "status_code").limit(20)


@query("SELECT min(domain) AS first_domain, max(domain) AS last_domain, max(fetched_at) AS last_fetch FROM domain_metadata")
def key_range(t):
    return t.meta.agg(F.min("domain").alias("first_domain"), F.max("domain").alias("last_domain"), F.max("fetched_at").alias("last_fetch"))


@query("SELECT id, domain, name, title, email FROM domain_employees WHERE id IN (1, 2, 3, 500)")
def point_lookup(t):
    return t.people.filter(F.col("id").isin(1, 2, 3, 500)).select("id", "domain", "name", "title", "email")


# ---- functions -----------------------------------------------------------------------------------------------------


@query("SELECT id, regexp_replace(lower(regexp_extract(page_url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', '') AS host FROM domain_contacts WHERE page_url IS NOT NULL")
def host_extract(t):
    return t.contacts.filter("page_url is not null").select("id", domain_fn.host("page_url").alias("host"))


@query("""SELECT domain, CASE WHEN n > 2 AND parts[n - 1] IN ('co', 'com', 'org', 'net', 'edu', 'gov') THEN parts[n - 2] || '.' || parts[n - 1] || '.' || parts[n] WHEN n >= 2 THEN parts[n - 1] || '.' || parts[n] ELSE domain END AS root
    FROM (SELECT DISTINCT domain, string_split(domain, '.') AS parts, len(string_split(domain, '.')) AS n FROM domains)""")
def root_domain(t):
    return t.domains.select("domain").distinct().select("domain", domain_fn.root_domain("domain").alias("root"))


@query("SELECT '.' || string_split(domain, '.')[-1] AS tld, count(*) AS cnt FROM domains GROUP BY 1")
def tld_histogram(t):
    return t.domains.groupBy(domain_fn.tld("domain").alias("tld")).agg(F.count(F.lit(1)).alias("cnt"))


def _case(patterns: list[tuple[str, int]]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(path, '(?i){p}') THEN {n}" for p, n in patterns) + " ELSE 0 END"


@query(f"SELECT id, {_case(domain_fn.PAGE_PRIORITY)}::INTEGER AS score FROM (SELECT id, coalesce(regexp_extract(page_url, '^[a-z]+://[^/]+(/[^?#]*)', 1), '') AS path FROM domain_contacts WHERE page_url IS NOT NULL)")
def url_scores(t):
    return t.contacts.filter("page_url is not null").select("id", domain_fn.url_score("page_url").alias("score"))


@query("""SELECT id, trim(value, ' ') AS phone FROM (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS d FROM domain_contacts WHERE entity_type = 'phone')
    WHERE length(d) BETWEEN 7 AND 15 AND len(list_distinct(string_split(d, ''))) >= 3 AND (length(d) >= 8 OR starts_with(trim(value, ' '), '+'))""")
def clean_phones(t):
    return t.contacts.filter("entity_type = 'phone'").select("id", contact_fn.clean_phone("value").alias("phone")).filter("phone is not null")


@query("""SELECT id, unnest(list_distinct(list_transform(regexp_extract_all(context, '[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{2,}'), lambda x: lower(x)))) AS email FROM domain_contacts WHERE contains(context, '@')""")
def emails_in_context(t):
    return t.contacts.filter(F.contains("context", F.lit("@"))).select("id", F.explode(contact_fn.emails("context")).alias("email"))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _root_sql(c: str) -> str:
    p = f"string_split({c}, '.')"
    return f"CASE WHEN len({p}) > 2 AND list_contains({_list(domain_fn.SECOND_LEVEL)}, {p}[-2]) THEN {p}[-3] || '.' || {p}[-2] || '.' || {p}[-1] WHEN len({p}) >= 2 THEN {p}[-2] || '.' || {p}[-1] ELSE {c} END"


@query(f"""SELECT id, email FROM (SELECT id, email, domain, string_split(email, '@')[1] AS local, string_split(email, '@')[-1] AS mail_host FROM domain_employees WHERE contains(email, '@'))
    WHERE NOT list_contains({_list(contact_fn.GENERIC)}, lower(local)) AND (({_root_sql("mail_host")}) = ({_root_sql("domain")}) OR list_contains({_list(contact_fn.PERSONAL)}, {_root_sql("mail_host")}))""")
def own_emails(t):
    return t.people.filter(contact_fn.is_employee_email("email", "domain")).select("id", "email")


# the tables' hosts stand in for the networks'
HOSTS = {"linkedin": ["linkedin.example"], "twitter": ["twitter.example"], "facebook": ["facebook.example"], "instagram": ["instagram.example"], "youtube": ["youtube.example"], "whatsapp": ["wa.example"]}
PATHS = contact_fn.SOCIAL_PATHS | {"youtube": [("youtube", "@")], "whatsapp": [("whatsapp", "[0-9]")]}


@query(f"""SELECT entity_type, kind, count(*) AS cnt FROM (SELECT entity_type, CASE {" ".join(f"WHEN regexp_matches(value, '{p.replace("'", "''")}') THEN '{k}'" for k, p in contact_fn.social_patterns(HOSTS, PATHS))} END AS kind FROM domain_contacts) GROUP BY 1, 2""")
def social_kinds(t):
    rows = t.contacts.select("entity_type", contact_fn.social_kind("value", HOSTS, PATHS).alias("kind"))
    return rows.groupBy("entity_type", "kind").agg(F.count(F.lit(1)).alias("cnt"))


@query(f"SELECT row_number() OVER (ORDER BY domain) AS n, ((row_number() OVER (ORDER BY domain) - 1) % 300 + 1)::INTEGER AS shard, domain FROM (SELECT DISTINCT domain FROM domains)")
def dealt_shards(t):
    every = t.domains.select("domain").distinct()
    return ranks.dealt(ranks.numbered(every, [F.col("domain")]), [F.col("domain")])


@query("""SELECT id, recent_errors, recent_errors > 60 AS warn FROM (SELECT id, sum((score IS NULL)::INTEGER) OVER (ORDER BY id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)::BIGINT AS recent_errors FROM domain_contacts)""")
def rolling_errors(t):
    return reports.rolling_errors(t.contacts.select("id", "score"), "id", F.col("score").isNull(), items=100, warn=60).drop("score")


@query("""SELECT count(*) AS crawled, sum(contacts_found)::BIGINT AS contacts, count(*) FILTER (k = 'success') AS success, count(*) FILTER (k = 'dns_fail') AS dns_fail, count(*) FILTER (k = 'timeout') AS timeout, count(*) FILTER (k = 'conn_error') AS conn_error,
    count(*) FILTER (k = 'ssl_error') AS ssl_error, count(*) FILTER (k = 'other') AS other, round(count(*) / 100.0::DOUBLE, 1) AS rate, round((1000000 - count(*)) / (count(*) / 100.0::DOUBLE) / 60, 0) AS minutes_left,
    count(*) FILTER (k <> 'success') AS errors, round(count(*) FILTER (k <> 'success') * 100.0::DOUBLE / count(*), 1) AS error_pct
    FROM (SELECT *, CASE WHEN status_code = 200 THEN 'success' WHEN status_code = -1 THEN 'timeout' WHEN status_code = -2 THEN 'dns_fail' WHEN status_code IN (-3, -6) THEN 'conn_error' WHEN status_code = -4 THEN 'ssl_error'
    WHEN contains(coalesce(error_msg, ''), 'connection_failed') THEN 'conn_error' ELSE 'other' END AS k FROM domain_crawl_status)""")
def crawl_progress(t):
    return reports.progress(t.crawl, 1_000_000, 100.0)


@query("""WITH c AS (SELECT * FROM (SELECT DISTINCT domain, title, description, category, location, email_count, phone_count, linkedin_count, social_count, emp_count, quality_score FROM domain_metadata WHERE status_code = 200 AND quality_score > 0 ORDER BY quality_score DESC, domain LIMIT 50)
      ORDER BY quality_score DESC, domain LIMIT 20)
    SELECT * FROM (SELECT 'category' AS kind, coalesce(nullif(category, ''), 'unknown') AS key, count(*) AS n FROM c GROUP BY 2 ORDER BY n DESC, key LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'location', key, count(*) AS n FROM (SELECT left(trim(split_part(trim(location), ',', 1)), 30) AS key FROM c) WHERE key <> '' GROUP BY key ORDER BY n DESC, key LIMIT 5)
    UNION ALL SELECT 'contact', 'email', sum(email_count)::BIGINT FROM c UNION ALL SELECT 'contact', 'phone', sum(phone_count)::BIGINT FROM c UNION ALL SELECT 'contact', 'linkedin', sum(linkedin_count)::BIGINT FROM c""")
def card_insights(t):
    return reports.insights(leads.discover(t.meta, leads.Filters(), batch=50), [F.col("quality_score").desc(), F.col("domain")])


@query("SELECT domain, max(quality_score) AS best FROM domain_metadata WHERE category = 'exim' GROUP BY domain ORDER BY best DESC NULLS LAST, domain LIMIT 200")
def guarded_sql(t):
    t.meta.createOrReplaceTempView("domain_metadata")
    return guard.run_query(t.spark, "SELECT domain, max(quality_score) AS best FROM domain_metadata WHERE category = 'exim' GROUP BY domain ORDER BY best DESC NULLS LAST, domain LIMIT 5000;")


@query("""SELECT id, domain, entity_type, value FROM (SELECT *, row_number() OVER (PARTITION BY domain, entity_type, lower(value) ORDER BY id) AS rn FROM domain_contacts) WHERE rn = 1""")
def contacts_first_wins(t):
    rows = t.contacts.withColumn("low", F.lower("value"))
    return maintenance.first_arrivals(rows, ["domain", "entity_type", "low"], [F.col("id")]).select("id", "domain", "entity_type", "value")


@query("""SELECT domain, name, arg_min(title, id) FILTER (title IS NOT NULL AND title <> '') AS title, arg_min(email, id) FILTER (email IS NOT NULL AND email <> '') AS email,
    arg_min(phone, id) FILTER (phone IS NOT NULL AND phone <> '') AS phone FROM domain_employees GROUP BY domain, name""")
def merge_people(t):
    first = lambda c: F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("id"))).alias(c)
    return t.people.groupBy("domain", "name").agg(first("title"), first("email"), first("phone"))


def _category_sql() -> str:
    lists = {k: "[" + ", ".join(f"'{w}'" for w in ws) + "]" for k, ws in STARTER.items()}
    every = "[" + ", ".join(f"'{w}'" for w in sorted({w for ws in STARTER.values() for w in ws})) + "]"
    counts = ", ".join(f"len(list_filter(tok, lambda x: list_contains({v}, x))) AS {k}" for k, v in lists.items())
    return f"""WITH d AS (SELECT DISTINCT domain, string_split_regex(lower(trim(domain)), '[^a-z0-9]+') AS raw FROM domains),
        t AS (SELECT domain, list_filter(list_distinct(list_concat(raw, flatten(list_transform(list_filter(raw, lambda a: length(a) > 5), lambda a: list_filter({every}, lambda k: contains(a, k) AND k <> a))))), lambda x: length(x) >= 3) AS tok FROM d),
        s AS (SELECT domain, {counts} FROM t)
        SELECT domain, CASE WHEN greatest(commodity, exim, logistics) = 0 THEN NULL WHEN commodity = greatest(commodity, exim, logistics) THEN 'commodity' WHEN exim = greatest(commodity, exim, logistics) THEN 'exim' ELSE 'logistics' END AS category FROM s"""


@query(_category_sql())
def categorize(t):
    return t.domains.select("domain").distinct().select("domain", category("domain").alias("category"))


@query("SELECT coalesce(domain, '') AS domain, coalesce(title, '') AS title, coalesce(category, '') AS category, coalesce(location, '') AS location, coalesce(quality_score::VARCHAR, '') AS quality_score, coalesce(email_count::VARCHAR, '') AS email_count, coalesce(phone_count::VARCHAR, '') AS phone_count, coalesce(linkedin_count::VARCHAR, '') AS linkedin_count FROM domain_metadata")
def csv_rows(t):
    return sinks.for_csv(t.meta, sinks.CARD_COLUMNS)


# ---- streams: the table's files as a stream, run until all of them are taken --------------------------------------


def _stream(t, table: str) -> DataFrame:
    return crawl.table_rows(t.spark, f"{t.folder}/{table}.parquet")


def _own_folder(t) -> str:
    return f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"


@query("SELECT domain, min(id) AS id, count(*) OVER () AS domains FROM domain_contacts GROUP BY domain")
def stream_first_arrivals(t):
    folder = _own_folder(t)
    for _ in range(2):  # a second run finds nothing new
        crawl.ingest_once(_stream(t, "domain_contacts").select("domain", "id"), f"{folder}/out", "domain", "id", f"{folder}/state").awaitTermination()
    out = t.spark.read.parquet(f"{folder}/out/rows").select("domain", "id")
    return out.join(out.agg(F.count(F.lit(1)).alias("domains")), F.lit(True))


@query("""SELECT date_trunc('day', crawled_at)::TIMESTAMP AS day, status_code, count(*) AS rows, count(*) FILTER (error_msg <> '')::BIGINT AS errors FROM domain_crawl_status WHERE crawled_at IS NOT NULL GROUP BY 1, 2""")
def stream_windows(t):
    folder = _own_folder(t)
    windows = crawl.status_windows(_stream(t, "domain_crawl_status")).select(F.col("window.start").cast("timestamp_ntz").alias("day"), "status_code", "rows", "errors")
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/out")
    windows.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{folder}/out")


from quarryline.plans import vectors  # noqa: E402

QUERIES |= vectors.QUERIES
ORACLE |= vectors.ORACLE
