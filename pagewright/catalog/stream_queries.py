"""Structured Streaming jobs, run over the page and event files until everything available is read."""

from pyspark.sql import functions as F

from pagewright.catalog import inputs as I
from pagewright.catalog.crawl_queries import PATHS, disallowed
from pagewright.catalog.registry import query
from pagewright.catalog.scalar_queries import TYPE_OK
from pagewright.functions.http import content_hash
from pagewright.operators.gates import fetch_gate
from pagewright.operators.robots import robots_records
from pagewright.plans.content import extract_links
from pagewright.session import is_folder, scratch_path
from pagewright.streaming import crawl, grouping


def stream_of(t, table: str):
    """A table as a stream, be it a folder of files or one file among others."""
    schema, path = getattr(t, table).schema, f"{t.folder}/{table}.parquet"
    if is_folder(t.spark, path):
        return crawl.page_stream(t.spark, path, schema)
    return crawl.page_stream(t.spark, t.folder, schema, f"{table}.parquet")


def web_pages(t):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    fetched = start + F.make_dt_interval(secs=F.col("page_id"))
    return stream_of(t, "pages").select(
        "url", F.col("html").alias("document"), F.lit("text/html").alias("type"), fetched.alias("fetched_at")
    )


def plain_texts(t):
    """Documents as pages: many texts are exact copies."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return stream_of(t, "documents").select(
        F.concat(F.lit("http://docs.example.com/"), "doc_id").alias("url"), F.col("text").alias("document"),
        F.lit("text/html").alias("type"), (start + F.make_dt_interval(secs=F.col("doc_id"))).alias("fetched_at"),
    )


def collected(t, stream):
    """Run to the end into a scratch table."""
    out = scratch_path(t.spark, "stream-out")
    crawl.run_to_parquet(stream, out, scratch_path(t.spark, "stream-state"))
    return t.spark.read.schema(stream.schema).parquet(out)


@query("R1_stream_source", "SELECT url, md5(html) AS hash FROM pages")
def _(t):
    return collected(t, web_pages(t).select("url", content_hash(F.col("document")).alias("hash")))


LOG = I.FETCH_LOG.replace("{events}", "{stream}")


@query("R2_stream_fetch_gate", f"""
SELECT id, url, type FROM ({I.FETCH_LOG}) WHERE status < 400 AND coalesce(content_length <= 2000000, true)
  AND (type LIKE 'text/html%' OR type LIKE 'text/xml%' OR type LIKE 'application/xml%' OR contains(type, '+xml'))""")
def _(t):
    fetched = t.spark.sql(LOG, stream=stream_of(t, "events"))
    return collected(t, fetch_gate(fetched, 2).select("id", "url", "type"))


GATE = f"""coalesce(content_length <= 2000000, true) AND status < 400 AND {TYPE_OK}"""


@query("R2_stream_gate_routes", f"""
WITH log AS ({I.FETCH_LOG}), paths AS ({PATHS})
SELECT id, CASE WHEN path LIKE '/purchase%' OR path LIKE '/click%' THEN 'frontier' ELSE 'keep' END AS route
FROM log JOIN paths USING (id) WHERE {GATE} AND (path LIKE '/click%' OR NOT {disallowed('path')})""")
def _(t):
    # clicks were asked for under the http site and answered by the https one
    answered = F.when(F.col("type") == "application/rss+xml", F.regexp_replace("url", "^http:(.*):80/", "https:$1:443/"))
    fetched = t.spark.sql(LOG, stream=stream_of(t, "events")).withColumn("final_url", answered)
    pages = fetched.withColumn("document", F.lit(""))
    routed = crawl.accepted_pages(pages, robots_records(t.sql(I.ROBOTS)))
    return collected(t, routed.select("id", "route"))


@query("R3_stream_content_dedupe", "SELECT min(doc_id) AS doc_id, md5(text) AS hash FROM documents GROUP BY 2")
def _(t):
    return kept_contents(stored(t, plain_texts(t)))


@query("R3_stream_content_dedupe_bounded", "SELECT min(doc_id) AS doc_id, md5(text) AS hash FROM documents GROUP BY 2")
def _(t):
    return kept_contents(stored(t, plain_texts(t), within="7 days"))


@query("R4_stream_link_extraction", f"WITH {I.LINKS_SQL} SELECT source, dest, count(*) AS n FROM normal_links GROUP BY 1, 2")
def _(t):
    links = collected(t, extract_links(web_pages(t)))
    return links.groupBy("source", "dest").agg(F.count("*").alias("n"))


def stored(t, pages, **options):
    folder = scratch_path(t.spark, "crawl-tables")
    crawl.crawl_stream(pages, folder, scratch_path(t.spark, "crawl-state"), **options).awaitTermination()
    return crawl.CrawlTables(t.spark, folder)


def kept_contents(tables):
    pages = tables.docs().join(tables.urls(), "id")
    number = F.regexp_extract("url", "([0-9]+)$", 1).cast("long")
    return pages.select(number.alias("doc_id"), content_hash(F.col("content")).alias("hash"))


NORMAL_URL = """regexp_extract(url, '^(https?://[^/]+)', 1) || CASE WHEN url LIKE 'https:%' THEN ':443' ELSE ':80' END
  || regexp_extract(url, '^https?://[^/]+(/.*)$', 1)"""


@query("R5_stream_upsert_sinks", f"""
SELECT row_number() OVER (ORDER BY {NORMAL_URL}) AS id, {NORMAL_URL} AS url, html AS content, 'text/html' AS type FROM pages""")
def _(t):
    tables = stored(t, web_pages(t))
    return tables.urls().select("id", "url").join(tables.docs(), "id")


@query("R6_stream_last_seen", "SELECT 'http://u' || user_id AS url, max(ts) AS last_crawled FROM events GROUP BY 1")
def _(t):
    seen = stream_of(t, "events").select(
        F.concat(F.lit("http://u"), "user_id").alias("url"), F.col("ts").alias("fetched_at")
    )
    return crawl.run_latest(
        crawl.last_seen(seen), scratch_path(t.spark, "last-seen"), scratch_path(t.spark, "last-seen-state"), "url"
    )


@query("R6_stored_last_seen", "SELECT 'http://u' || user_id AS url, max(ts) AS last_crawled FROM events GROUP BY 1")
def _(t):
    seen = stream_of(t, "events").select(
        F.concat(F.lit("http://u"), "user_id").alias("url"), F.col("ts").alias("fetched_at")
    )
    state = scratch_path(t.spark, "last-seen-state")
    crawl.run_latest(crawl.last_seen(seen), scratch_path(t.spark, "last-seen"), state, "url")
    return crawl.stored_last_seen(t.spark, state)


@query("R7_shuffle_grouping", "SELECT event_id FROM events")
def _(t):
    return collected(t, grouping.shuffle_grouping(stream_of(t, "events"), 4).select("event_id"))


@query("R8_fields_grouping", "SELECT user_id, count(*) AS n, CAST(1 AS BIGINT) AS consumers FROM events GROUP BY user_id")
def _(t):
    grouped = grouping.fields_grouping(stream_of(t, "events"), 4, "user_id")
    rows = collected(t, grouped.select("user_id", F.spark_partition_id().alias("consumer")))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("consumer").alias("consumers"))


@query("R9_all_grouping", "SELECT event_id, CAST(unnest([0, 1, 2]) AS INTEGER) AS consumer FROM events")
def _(t):
    return collected(t, grouping.all_grouping(stream_of(t, "events"), 3).select("event_id", "consumer"))


@query("R10_crawl_stream", f"""
WITH {I.LINKS_SQL} SELECT {NORMAL_URL.replace('url', 'source')} AS source, dest FROM normal_links GROUP BY ALL""")
def _(t):
    return stored(t, web_pages(t)).links().select("source", "dest")


# robots of the page sites: two kinds of rules by the end of the host
SITE = "regexp_extract(url, '^(https?://[^/]+)', 1)"
SITE_PORT = f"concat({SITE}, CASE WHEN url LIKE 'https:%' THEN ':443' ELSE ':80' END)"
SITE_ROBOTS = f"""
SELECT DISTINCT {SITE_PORT} AS domain,
  CASE WHEN {SITE} LIKE '%.org' THEN concat('User-agent: *', chr(10), 'Disallow: /de', chr(10), 'Crawl-delay: 2.5')
       WHEN {SITE} LIKE '%.net' THEN concat('User-agent: *', chr(10), 'Allow: /them', chr(10), 'Disallow: /the', chr(10), 'Crawl-delay: 7')
  END AS robots_txt, false AS timed_out FROM {{pages}}"""
REFUSED = """(({0} LIKE '%.org:80' OR {0} LIKE '%.org:443') AND {1} LIKE '/de%'
  OR ({0} LIKE '%.net:80' OR {0} LIKE '%.net:443') AND {1} LIKE '/the%' AND {1} NOT LIKE '/them%')"""


@query("R10_crawl_frontier", f"""
WITH fetched AS (
  SELECT {NORMAL_URL} AS url, {SITE_PORT} AS domain, regexp_extract(url, '^https?://[^/]+(/.*)$', 1) AS path, html,
    url AS written, TIMESTAMP '2024-01-01' + to_seconds(page_id) AS fetched_at FROM pages),
accepted AS (SELECT * FROM fetched WHERE NOT {REFUSED.format('domain', 'path')}),
first AS (SELECT * FROM accepted QUALIFY row_number() OVER (PARTITION BY md5(html) ORDER BY fetched_at, url) = 1),
found AS (SELECT DISTINCT domain, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS path FROM first),
fresh AS (
  SELECT domain, domain || path AS url FROM found
  WHERE NOT {REFUSED.format('domain', 'path')} AND domain || path NOT IN (SELECT url FROM accepted)),
delays AS (
  SELECT domain, CASE WHEN domain LIKE '%.org:%' THEN 2500 WHEN domain LIKE '%.net:%' THEN 7000 ELSE 0 END AS delay,
    max(fetched_at) AS last FROM accepted GROUP BY 1)
SELECT url, greatest((SELECT max(fetched_at) FROM accepted), last + to_milliseconds(delay))
    + to_milliseconds((row_number() OVER (PARTITION BY domain ORDER BY url) - 1) * delay) AS date_added
FROM fresh JOIN delays USING (domain)""")
def _(t):
    return stored(t, web_pages(t), records=robots_records(t.sql(SITE_ROBOTS))).frontier()


@query("D4_user_defined_step", "SELECT user_id, value * 2 AS doubled FROM events WHERE event_type = 'purchase'")
def _(t):
    def step(rows):
        return rows.where("event_type = 'purchase'").select("user_id", (F.col("value") * 2).alias("doubled"))

    return collected(t, crawl.apply_step(stream_of(t, "events"), step))
