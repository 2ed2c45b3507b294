import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from quarryline.functions import contacts as contact_fn
from quarryline.functions import domains as domain_fn
from quarryline.functions import fulltext, html
from quarryline.functions.categories import category
from quarryline.operators import leads, maintenance, ranks, reports, scoring
from quarryline.plans import guard, registry
from quarryline.sources import ingest, sinks
from quarryline.streaming import crawl

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, FOLDER)
    cursor = duck.execute(registry.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted([tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall()], key=str)
    got = sorted([tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()], key=str)
    assert got == want


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    ("fn", "given", "want"),
    [
        (domain_fn.site_domain, "https://www.Acme.com/x", "acme.com"), (domain_fn.site_domain, "https://a.github.io/", None), (domain_fn.site_domain, "https://x.xyz/", None), (domain_fn.site_domain, "::bad", None),
        (domain_fn.certificate_root, "*.shop.acme.co.uk", "acme.co.uk"), (domain_fn.certificate_root, "10.0.0.1", None), (domain_fn.root_domain, "mail.acme.co.in", "acme.co.in"), (domain_fn.zone_domain, "Acme.COM. 3600 in ns a.b.", "acme.com"),
        (domain_fn.url_score, "https://a.com/contact-us", 12), (domain_fn.url_score, "https://a.com/blog", 0), (domain_fn.tld, "acme.co.in", ".co.in"),
        (contact_fn.clean_phone, "1234567", None), (contact_fn.clean_phone, "+1234567", "+1234567"), (contact_fn.clean_phone, "11111111", None), (contact_fn.spaced_emails, "Write JO @ acme.com now", ["jo@acme.com"]),
        (contact_fn.decode_hidden_email, "", ""), (category, "agri-exports.co.in", "commodity"), (category, "xyz.com", None),
    ],
)
def test_vectors(spark, fn, given, want):
    if fn is contact_fn.decode_hidden_email:
        key, text = 0x42, "jo@acme.com"
        given, want = bytes([key, *[ord(c) ^ key for c in text]]).hex(), text
    assert value(spark, fn(F.lit(given))) == want
    assert value(spark, fn(F.lit(None).cast("string"))) in (None, 0)


def test_employee_emails(spark):
    check = lambda e: value(spark, contact_fn.is_employee_email(F.lit(e), F.lit("acme.com")))
    assert [check(e) for e in ("jo@acme.com", "info@acme.com", "jo@gmail.com", "jo@other.com")] == [True, False, True, False]


def test_reports(spark):
    rows = spark.createDataFrame([(200, None), (-3, None), (-6, None), (-4, None), (500, "connection_failed_500"), (404, None)], "status_code int, error_msg string")
    assert [r.c for r in rows.select(reports.error_class().alias("c")).collect()] == ["success", "conn_error", "conn_error", "ssl_error", "conn_error", "other"]
    assert value(spark, reports.whole_percent(F.lit(2), F.lit(3))) == 66 and value(spark, reports.whole_percent(F.lit(2), F.lit(0))) == 0
    assert [value(spark, scoring.quality_class(F.lit(n))) for n in (60, 59, 30, 29)] == ["high", "medium", "medium", "low"]
    assert value(spark, scoring.short_number(F.lit(1_200_000))) == "1.2M" and not leads.has_more(30, 20, 10)
    rolling = reports.rolling_errors(spark.range(5), "id", F.col("id") > 1, items=2, warn=1).orderBy("id").collect()
    assert [r.recent_errors for r in rolling] == [0, 0, 1, 2, 2] and rolling[-1].warn


def test_writes_are_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, v int, category string")
    new = spark.createDataFrame([("b", 3, "n", 1), ("b", 4, "m", 2), ("c", 5, None, 3)], "k string, v int, category string, at int")
    once = maintenance.upsert(old.withColumn("at", F.lit(0)), new, ["k"], [F.col("at").desc()], keep=["category"])
    twice = maintenance.upsert(once, new, ["k"], [F.col("at").desc()], keep=["category"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str) == [("a", 1, "x", 0), ("b", 4, None, 2), ("c", 5, None, 3)]
    added = maintenance.insert_ignore(old, new.drop("at"), ["k"], [F.col("v")])
    assert sorted(r.v for r in added.collect()) == [1, 2, 5]
    assert sorted(r.v for r in maintenance.fill_missing(old, spark.createDataFrame([("b", "y")], "k string, category string"), "k", "category").filter("category = 'y'").collect()) == [2]


def test_keyset_pages_and_shards_cover_all(spark):
    todo, done = spark.range(50).select(F.format_string("%03d", "id").alias("domain")), spark.createDataFrame([("007",)], "domain string")
    seen, last = [], ""
    while batch := [r.domain for r in maintenance.work_list(todo, done, after=last, batch=8).collect()]:
        seen += batch
        last = batch[-1]
    assert len(seen) == 49 and seen == sorted(set(seen))
    assert sum(maintenance.work_list(todo, done, shard=i, shards=4).count() for i in range(4)) == 49


def test_filters_with_nulls(spark):
    df = spark.createDataFrame([("a", None), ("b", "India"), ("c", "50%_x")], "domain string, location string")
    assert [r.domain for r in df.filter(leads.lacks_text("location", "india")).orderBy("domain").collect()] == ["a", "c"]
    assert df.filter(leads.has_text("location", "%_")).count() == 1 and df.filter(leads.like_text("location", "%_")).count() == 2
    assert leads.Filters().apply(df).count() == 3


def test_fulltext(spark):
    df = spark.createDataFrame([("Shipping peppers", None), ("steel pipes", "x"), (None, None)], "a string, b string")
    hit = lambda q: [r.a for r in df.filter(fulltext.match(fulltext.positions("a", "b"), q)).collect()]
    assert hit("pepper") == ["Shipping peppers"] and hit('"steel pipes" or shipped') == ["Shipping peppers", "steel pipes"] and hit("steel -pipe") == [] and hit("the") == []


def test_pages(spark):
    page = '<html lang=en><head><title>A &amp; B</title><meta name="description" content="hi"></head><body><a href="mailto:Jo@Acme.com?x">Jo</a><div class="team-member"><h3>Ann Lee</h3><p>Sales Manager</p></div><a href="/about#x">x</a> suesan [at] acme [dot] com'
    df = spark.createDataFrame([(page, "https://acme.com/"), (None, None), ("", ""), ("<p>" * 2000, "u")], "html string, url string")
    head = html.with_head(df).collect()
    assert (head[0].title, head[0].description, head[0].language) == ("A & B", "hi", "en") and head[1].title is None
    body = html.with_page(df).collect()
    assert [c.value for c in body[0].contacts] == ["jo@acme.com", "suesan@acme.com"] and body[0].links == ["https://acme.com/about#x"] and body[0].people == []
    assert body[1].contacts == [] and html.hidden_email("zz") is None


def test_sources(spark, tmp_path):
    lines = ['com,acme)/ 20250101 {"url": "https://www.acme.com/a", "status": "200", "mime": "text/html"}', 'x 1 {"url": "https://b.com", "status": "404"}', "bad", 'x 2 {"url": "https://c.com/", "status": "200"}']
    out = ingest.crawl_index(spark.createDataFrame([(x,) for x in lines], "value string"), "s1").orderBy("domain").collect()
    assert [(r.domain, r.last_crawled, r.shard) for r in out] == [("acme.com", "20250101", "s1"), ("c.com", "2", "s1")]
    (tmp_path / "c.json").write_text('[{"name_value": "*.a.acme.com\\nb.org"}, {"name_value": "10.0.0.1"}]')
    assert sorted(r.domain for r in ingest.certificates(spark, str(tmp_path / "c.json")).collect()) == ["acme.com", "b.org"]
    import gzip

    (tmp_path / "i.gz").write_bytes(gzip.compress((lines[0] + "\n").encode()) + gzip.compress((lines[3] + "\n").encode()))
    assert ingest.read_crawl_index(spark, str(tmp_path / "i.gz")).count() == 2
    one = spark.createDataFrame([('say "x"', "d", None, 3)], "title string, domain string, category string, quality_score int")
    assert sinks.saved_lines(one).collect()[0].value == "d,\"say 'x'\",,3"


def test_stream_takes_each_key_once(spark, tmp_path):
    schema = spark.createDataFrame([], "domain string, n int").schema
    for i, rows in enumerate([[("a", 1), ("a", 2), ("b", 1)], [("b", 9), ("c", 1)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        crawl.ingest_once(crawl.new_rows(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), "domain", "n", str(tmp_path / "state")).awaitTermination(120)
    got = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "out/rows")).select("domain", "n").collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("b", 1), ("c", 1)]


def test_people_and_titles():
    assert html.is_person_name("Ann Lee") and not any(html.is_person_name(x) for x in ("Ann", "Our Team", "Ann 2", "ann lee", "Frequently Asked Questions Page", "A " * 6))
    assert html.is_title("Sales Manager") and not any(html.is_title(x) for x in ("", "x", "manager", "She is the Manager", "Manager: sales", "Manager, a, b", "Plumber"))
    page = html.tree('<a href="mailto:a@b.com">Jo Silva</a><a href="mailto:c@d.com">Jo</a>')
    assert html.anchor_index(page)[0] == {"josilva": "a@b.com", "jo": "c@d.com"} or html.anchor_index(page)[0]["jo silva"] == "a@b.com"
    # nested blocks are read by their spans
    deep = html.tree("<div>" * 3000 + "x" + "</div>" * 3000)
    assert deep.text(0) == "x" and html.parse_page("<p>" * 5000 + "call 020 7946 0018", "https://a.com/team")["contacts"][0]["value"] == "020 7946 0018"


@pytest.mark.parametrize(
    "sql",
    ["drop table x", "insert into domains values (1)", "select 1; select 2", "create view v as select 1", "select * from information_schema.tables", "select * from parquet.`/etc`", "set a = b", "select * from (select * from pg_catalog.x)", "select (select max(a) from pg_catalog.x)", "nonsense", "", "with a as (select * from pg_catalog.x) select * from a", "select * from no_such_table"],
)
def test_guard_refuses(spark, sql):
    with pytest.raises(guard.Refused):
        guard.run_query(spark, sql)


def test_guard_runs_queries(spark):
    assert guard.run_query(spark, "select 'drop table x' as a, id from range(1000) -- delete\n limit 900", 7).count() == 7
    assert guard.run_query(spark, "with a as (select id from range(3)) select * from a where id in (select id from range(2)) order by id").count() == 2


def test_numbers_by_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = ranks.numbered(df, [F.col("k")], partitions=7).collect()
    assert len(got) == 1000 and all(r.n == r.k + 1 for r in got)
    total = {r.n: r.running for r in ranks.running(df, [F.col("k")], F.col("k")).collect()}
    assert total[1000] == 999 * 500 and total[1] == 0 and total[3] == 3
    assert ranks.numbered(df.limit(0), [F.col("k")]).count() == 0
    plan = ranks.dealt(df, [F.col("k")], 10)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.replace("Exchange SinglePartition, ENSURE_REQUIREMENTS", "", 1)  # only the partitions' sizes meet in one task


def test_stream_tables_are_written_together(spark, tmp_path):
    schema = spark.createDataFrame([], "domain string, n int").schema
    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.parquet(str(tmp_path / "in"))
    made = {"status": lambda rows: rows.groupBy("n").agg(F.count(F.lit(1)).alias("c"))}
    query = crawl.ingest_once(crawl.new_rows(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), "domain", "n", str(tmp_path / "state"), made)
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/status")).count() == 2 and spark.read.parquet(str(tmp_path / "out/keys")).count() == 2
    assert crawl.progress_of(query)["rows"] == 2


@pytest.mark.parametrize(("name", "table"), [("stream_first_arrivals", "domain_contacts"), ("stream_windows", "domain_crawl_status")])
def test_streams_take_tables_in_folders(spark, duck, tmp_path, name, table):
    spark.read.parquet(f"{FOLDER}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    got = registry.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted((tuple(map(plain, r)) for r in got), key=str) == sorted((tuple(map(plain, r)) for r in duck.execute(registry.ORACLE[name]).fetchall()), key=str)


def test_streams_take_a_file_beside_a_partitioned_table(spark, duck, tmp_path):
    os.symlink(f"{FOLDER}/domain_crawl_status.parquet", tmp_path / "domain_crawl_status.parquet")
    spark.range(2).withColumn("part", F.col("id")).write.partitionBy("part").parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES["stream_windows"](spark, str(tmp_path)).collect()
    assert sorted((tuple(map(plain, r)) for r in got), key=str) == sorted((tuple(map(plain, r)) for r in duck.execute(registry.ORACLE["stream_windows"]).fetchall()), key=str)


def test_stream_windows(spark, tmp_path):
    rows = spark.sql("select timestamp'2025-01-01 10:00' crawled_at, 200 status_code, '' error_msg, 'a' k union all select timestamp'2025-01-01 11:00', 200, 'x', 'a' union all select timestamp'2025-01-20 00:00', 404, null, 'b'")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = crawl.new_rows(spark, str(tmp_path / "in"), rows.schema)
    for name, df in (("w", crawl.status_windows(stream)), ("d", crawl.without_replays(stream, ["k"], "crawled_at"))):
        df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted((r.rows, r.errors) for r in spark.table("w").collect()) == [(2, 1)]
    assert sorted(r.k for r in spark.table("d").collect()) == ["a", "b"]


def test_retries_and_tables(spark):
    rows = spark.createDataFrame([(503, None), (404, None), (None, "ssl"), (None, "dns")], "http_status int, failure string")
    assert [r.v for r in rows.select(ingest.may_retry().alias("v")).collect()] == [True, False, True, False]
    spark.range(2).createOrReplaceTempView("probe")
    assert ingest.has_table(spark, "probe", ["id"]) and not ingest.has_table(spark, "probe", ["x"]) and not ingest.has_table(spark, "nothing")
    assert [r.domain for r in ingest.keys(spark, ["b", "a"]).orderBy("pos").collect()] == ["b", "a"]


def test_tables_over_jdbc(spark):
    if not any("derby" in os.path.basename(j) for j in glob.glob(os.path.join(os.path.dirname(__import__("pyspark").__file__), "jars", "*.jar"))):
        pytest.skip("no relational engine at hand")
    url, driver = "jdbc:derby:memory:quarryline;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    ingest.write_table_over_jdbc(spark.range(100).select("id", F.concat(F.lit("d"), "id").alias("domain")), url, "leads", batch=10, **driver)
    df = ingest.read_table_over_jdbc(spark, url, "leads", "id", 0, 100, 4, **driver)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    assert maintenance.copy_columns(df.withColumn("more", F.lit(1)), spark.createDataFrame([], "domain string, id int")).dtypes == [("domain", "string"), ("id", "int")]


def test_exports_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([("d", 'say "x", twice', None, None, 3, None, 1, 0)], "domain string, title string, category string, location string, quality_score int, email_count int, phone_count int, linkedin_count int")
    sinks.write_csv(df.coalesce(1), sinks.CARD_COLUMNS, str(tmp_path / "out"))
    lines = [x for p in glob.glob(str(tmp_path / "out/*.csv")) for x in open(p).read().splitlines()]
    assert lines == [",".join(sinks.CARD_COLUMNS), 'd,"say ""x"", twice",,,3,,1,0']
