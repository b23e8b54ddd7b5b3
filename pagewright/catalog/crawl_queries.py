"""Crawl planning jobs: robots rules, frontier, recrawl, dedupe, sharding."""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.catalog import inputs as I
from pagewright.catalog.registry import query
from pagewright.catalog.scalar_queries import TYPE_OK, log
from pagewright.functions.http import content_hash, format_http_date
from pagewright.operators import frontier, gates, robots, tables
from pagewright.session import scratch_path
from pagewright.streaming.grouping import read_shard, write_by_shard

# the same rules written out by user, for the oracle
PATHS = "SELECT event_id AS id, user_id, '/' || event_type || '/' || event_id AS path FROM events"
RULES = """
site AS (SELECT DISTINCT user_id, 'http://u' || user_id || '.example.com:80' AS domain FROM events),
rules AS (
  SELECT domain, 'disallow' AS kind, '/view' AS pattern, 2.5 AS delay FROM site WHERE user_id < 40
  UNION ALL SELECT domain, 'allow', '/view/1', 2.5 FROM site WHERE user_id < 40
  UNION ALL SELECT domain, 'disallow', '/signup/*5$', 5.0 FROM site WHERE user_id >= 40 AND user_id < 80
  UNION ALL SELECT domain, 'disallow', '/*/1', 0.0 FROM site WHERE user_id >= 110 AND user_id <= 140
  UNION ALL SELECT domain, 'disallow', '/', 0.0 FROM site WHERE user_id > 140)"""


def disallowed(path: str) -> str:
    return f"""(CASE WHEN user_id < 40 THEN {path} LIKE '/view%' AND NOT {path} LIKE '/view/1%'
  WHEN user_id < 80 THEN regexp_full_match({path}, '/signup/.*5')
  WHEN user_id < 110 THEN false
  WHEN user_id <= 140 THEN regexp_full_match({path}, '/.*/1.*')
  ELSE true END)"""


DELAY = "CASE WHEN user_id < 40 THEN 2500 WHEN user_id < 80 THEN 5000 ELSE 0 END"


@query("C1_robots_rules", f"WITH {RULES} SELECT domain, kind, pattern, CAST(delay AS DOUBLE) AS delay FROM rules")
def _(t):
    return robots.robots_rules(robots.robots_records(t.sql(I.ROBOTS)))


@query("C2_robots_filter", f"WITH paths AS ({PATHS}) SELECT id FROM paths WHERE NOT {disallowed('path')}")
def _(t):
    records = robots.robots_records(t.sql(I.ROBOTS))
    return robots.robots_filter(t.sql(I.FETCH_LOG).select("id", "url"), records).select("id")


@query("J10_robots_join", f"WITH paths AS ({PATHS}) SELECT id, path, {disallowed('path')} AS disallowed FROM paths")
def _(t):
    records = robots.robots_records(t.sql(I.ROBOTS))
    checked = robots.with_robots(t.sql(I.FETCH_LOG).select("id", "url"), records)
    return checked.select("id", F.regexp_extract("url", "^http://[^/]+(.*)$", 1).alias("path"), "disallowed")


@query("C3_crawl_delay", f"SELECT event_id AS id, {DELAY} / 1000.0 AS delay FROM events")
def _(t):
    records = robots.robots_records(t.sql(I.ROBOTS))
    return frontier.crawl_delay(t.sql(I.FETCH_LOG).select("id", "url"), records).select("id", "delay")


NOW = "TIMESTAMP '2024-01-20 00:00:00'"
LAST = f"""SELECT concat('http://u', CAST(user_id AS STRING), '.example.com:80') AS domain, max(ts) AS last_request
FROM {{events}} WHERE ts < {NOW} GROUP BY 1"""


def due(start: str, delay: str, place: str) -> str:
    """Not before the last request plus one delay, plus one delay per earlier URL."""
    return f"""greatest({NOW}, coalesce({start} + to_milliseconds({delay}), {NOW})) + to_milliseconds(({place} - 1) * {delay})"""


@query("C4_due_times", f"""
WITH last_requests AS ({LAST}), paths AS ({PATHS}), urls AS (
  SELECT id, user_id, 'http://u' || user_id || '.example.com:80' AS domain, {DELAY} AS delay,
    row_number() OVER (PARTITION BY user_id ORDER BY id) AS place FROM paths)
SELECT id, {due('last_request', 'delay', 'place')} AS due FROM urls LEFT JOIN last_requests USING (domain)""")
def _(t):
    records = robots.robots_records(t.sql(I.ROBOTS))
    urls = robots.with_robots(t.sql(I.FETCH_LOG).select("id", "url"), records).select("id", "domain", "delay")
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return frontier.due_times(urls, t.sql(LAST), now, ["id"]).select("id", "due")


# queued sites of odd users; everything seen is discovered again
QUEUED = f"""SELECT concat({I.USER_URL}, event_type) AS url, min(ts) AS date_added
FROM {{events}} WHERE event_type = 'view' GROUP BY 1"""


@query("C5_frontier_update", f"""
WITH last_requests AS ({LAST}), queued AS ({QUEUED}),
found AS (SELECT DISTINCT user_id, {I.USER_URL} || event_type AS url, '/' || event_type AS path FROM events),
fresh AS (SELECT * FROM found WHERE url NOT IN (SELECT url FROM queued) AND NOT {disallowed('path')}),
placed AS (SELECT *, 'http://u' || user_id || '.example.com:80' AS domain, {DELAY} AS delay,
  row_number() OVER (PARTITION BY user_id ORDER BY url) AS place FROM fresh)
SELECT url, date_added FROM queued UNION ALL
SELECT url, {due('last_request', 'delay', 'place')} FROM placed LEFT JOIN last_requests USING (domain)""")
def _(t):
    found = t.sql(f"SELECT concat({I.USER_URL}, event_type) AS url FROM {{events}}")
    records = robots.robots_records(t.sql(I.ROBOTS))
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return frontier.frontier_update(t.sql(QUEUED), found, records, t.sql(LAST), now)


@query("C6_next_batch", f"""
SELECT url, date_added FROM ({I.FRONTIER}) WHERE date_added <= TIMESTAMP '2024-01-02 00:00:00' ORDER BY date_added, url LIMIT 50""")
def _(t):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    return frontier.next_batch(t.sql(I.FRONTIER), now, 50)


@query("C7_domain_cap", f"""
WITH arrivals AS (SELECT id, url, fetched_at AS arrived_at, regexp_extract(url, '^(http://[^/]+)', 1) AS domain FROM ({I.FETCH_LOG})),
firsts AS (SELECT domain, min((arrived_at, url)) AS first FROM arrivals GROUP BY domain),
ordered AS (SELECT first, row_number() OVER (ORDER BY first) AS place FROM firsts)
SELECT id, url FROM arrivals WHERE coalesce((arrived_at, url) <= (SELECT first FROM ordered WHERE place = 100), true)""")
def _(t):
    arrivals = t.sql(I.FETCH_LOG).select("id", "url", F.col("fetched_at").alias("arrived_at"))
    return frontier.domain_cap(arrivals, 100).select("id", "url")


START = "TIMESTAMP '2024-01-31 00:00:00'"
# crawled at the last click, modified at the last view; the stored copy is a customer's segment
VISITS = f"""SELECT {I.USER_URL} AS url, max(CASE WHEN event_type = 'click' THEN ts END) AS last_crawled,
  max(CASE WHEN event_type = 'view' THEN ts END) AS modified FROM {{events}} GROUP BY 1"""
STORED = """SELECT concat('http://u', CAST(c_custkey AS STRING), '.example.com:80/') AS url, md5(c_mktsegment) AS hash
FROM {customer} WHERE c_acctbal > 0"""
USED = "SELECT DISTINCT md5(c_mktsegment) AS hash FROM {customer} WHERE c_acctbal = (SELECT min(c_acctbal) FROM {customer})"


@query("C8_recrawl_plan", f"""
WITH visits AS ({VISITS}), stored AS ({STORED}), used AS ({USED}),
joined AS (SELECT v.url, last_crawled, hash, coalesce(date_trunc('second', modified) < last_crawled, false) AS unchanged,
  coalesce({START} < last_crawled, false) AS done FROM visits v LEFT JOIN stored USING (url)),
firsts AS (SELECT hash, min(url) AS url FROM joined
  WHERE NOT done AND unchanged AND hash IS NOT NULL AND hash NOT IN (SELECT hash FROM used) GROUP BY hash)
SELECT url, CASE WHEN done THEN 'skip' WHEN NOT unchanged THEN 'fetch'
  WHEN url IN (SELECT url FROM firsts) THEN 'reuse' ELSE 'skip' END AS action FROM joined""")
def _(t):
    visits = t.sql(VISITS)
    fetches = visits.select("url", format_http_date(F.col("modified")).alias("last_modified"))
    seen = visits.where("last_crawled IS NOT NULL")
    start = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    plan = frontier.recrawl_plan(fetches, seen, t.sql(STORED), t.sql(USED), start)
    return plan.select("url", "action")


@query("C9_redirect_routes", f"""
WITH paths AS ({PATHS})
SELECT id, CASE WHEN path LIKE '/purchase%' THEN 'frontier' WHEN {disallowed('path')} THEN 'drop' ELSE 'keep' END AS route FROM paths""")
def _(t):
    log_rows = t.sql(I.FETCH_LOG).select("id", F.col("url").alias("final_url"))
    # purchases were asked for under the https site and answered by the http one
    asked = F.when(
        F.col("final_url").contains("/purchase"), F.regexp_replace("final_url", "^http:", "https:")
    ).otherwise(F.regexp_replace("final_url", ":80/.*$", "/start"))
    fetches = log_rows.withColumn("url", asked)
    records = robots.robots_records(t.sql(I.ROBOTS))
    return frontier.redirect_routes(fetches, records).select("id", "route")


@query("C10_content_dedupe", "SELECT min(doc_id) AS doc_id, md5(text) AS hash FROM documents GROUP BY md5(text)")
def _(t):
    kept = tables.first_per_content(t.documents, "text", ["doc_id"], "doc_id")
    return kept.select("doc_id", content_hash(F.col("text")).alias("hash"))


SHARD_SQL = "CAST(CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT) % {1} AS INTEGER)"


# stored by shard, and every shard read on its own
@query("C11_domain_sharding", log(f"""
SELECT domain, {SHARD_SQL.format('domain', 8)} AS shard, n
FROM (SELECT regexp_extract(url, '^(http://[^/]+)', 1) AS domain, count(*) AS n FROM log GROUP BY 1)"""))
def _(t):
    path = scratch_path(t.spark, "shards")
    write_by_shard(t.sql(I.FETCH_LOG), path, 8)
    domain = F.regexp_extract("url", "^(http://[^/]+)", 1).alias("domain")
    shards = [read_shard(t.spark, path, n).groupBy(domain, "shard").agg(F.count("*").alias("n")) for n in range(8)]
    return functools.reduce(DataFrame.unionByName, shards)


@query("C12_fetch_gate", log(f"SELECT id, url FROM log WHERE {TYPE_OK} AND coalesce(content_length <= 2000000, true) AND status < 400"))
def _(t):
    return gates.fetch_gate(t.sql(I.FETCH_LOG), 2).select("id", "url")
