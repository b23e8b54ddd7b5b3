"""Logical tables derived from the driver's tables, as SQL that both engines read."""

from pagewright.functions.text import STOP_WORDS

# (id, text)
TEXTS = "SELECT doc_id AS id, text FROM {documents}"

# (id, content, type): plain texts and web pages in one table
CRAWLER_DOCS = """
SELECT doc_id + 1000000 AS id, text AS content, 'text/plain' AS type FROM {documents}
UNION ALL
SELECT page_id AS id, html AS content, 'text/html; charset=utf-8' AS type FROM {pages}"""

# (id, url, content, type): the same documents with the URL each was stored under
STORED_DOCS = """
SELECT doc_id + 1000000 AS id, concat('http://texts.example.com:80/', CAST(doc_id + 1000000 AS STRING)) AS url,
  text AS content, 'text/plain' AS type FROM {documents}
UNION ALL
SELECT page_id AS id, url, html AS content, 'text/html; charset=utf-8' AS type FROM {pages}"""

# (url, document, type)
WEB_PAGES = "SELECT url, html AS document, 'text/html; charset=utf-8' AS type FROM {pages}"

# (id, url, status, type, content_length, fetched_at): what a fetch reported
FETCH_LOG = """
SELECT event_id AS id,
  concat('http://u', CAST(user_id AS STRING), '.example.com:80/', event_type, '/', CAST(event_id AS STRING)) AS url,
  CASE event_type WHEN 'error' THEN 404 ELSE 200 END AS status,
  CASE event_type WHEN 'view' THEN 'text/html; charset=utf-8' WHEN 'click' THEN 'application/rss+xml'
    WHEN 'signup' THEN 'text/xml' WHEN 'purchase' THEN 'image/png' WHEN 'error' THEN 'application/xml' END AS type,
  CASE event_type WHEN 'click' THEN NULL ELSE CAST(floor(value * 20000) AS BIGINT) END AS content_length,
  ts AS fetched_at
FROM {events}"""

# (id, url): every shape of URL the normaliser knows
RAW_URLS = """
SELECT event_id AS id, CASE event_type
    WHEN 'view' THEN concat('http://u', CAST(user_id AS STRING), '.example.com')
    WHEN 'click' THEN concat(' https://u', CAST(user_id AS STRING), '.example.com/p/', CAST(event_id AS STRING), '?q=1#t ')
    WHEN 'signup' THEN concat('http://u', CAST(user_id AS STRING), '.example.com:8080/p/', CAST(event_id AS STRING))
    WHEN 'purchase' THEN concat('http://u', CAST(user_id AS STRING), '.example.com:xx/p')
    ELSE concat('mailto:u', CAST(user_id AS STRING), '@example.com') END AS url
FROM {events}"""

# (id, url): suppliers, some of them crawled under a URL that no link names, and (source, dest): links
# between all suppliers
SUPPLIER_URL = "concat('http://n', CAST({0}.s_nationkey AS STRING), '.example.com:80/s', CAST({0}.s_suppkey AS STRING))"
URLS = f"""
SELECT s_suppkey AS id, CASE WHEN s_acctbal > 0 THEN {SUPPLIER_URL.format('s')}
  ELSE concat('http://moved.example.com:80/s', CAST(s_suppkey AS STRING)) END AS url FROM {{supplier}} s"""
LINKS = f"""
SELECT DISTINCT {SUPPLIER_URL.format('sa')} AS source, {SUPPLIER_URL.format('sb')} AS dest
FROM {{lineitem}} a
JOIN {{lineitem}} b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
JOIN {{supplier}} sa ON sa.s_suppkey = a.l_suppkey
JOIN {{supplier}} sb ON sb.s_suppkey = b.l_suppkey"""

# (source, dest): part to next part of the same order; what points to every seventh part points to a
# node without links instead
EDGES = """
SELECT DISTINCT a.l_partkey AS source, CASE WHEN b.l_partkey % 7 = 0 THEN -b.l_partkey ELSE b.l_partkey END AS dest
FROM {lineitem} a JOIN {lineitem} b
  ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1"""

# (source, dest): customer to supplier, every supplier a sink
BIPARTITE = """
SELECT DISTINCT concat('c', CAST(o_custkey AS STRING)) AS source, concat('s', CAST(l_suppkey AS STRING)) AS dest
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""

# (qid, query)
QUERIES = "SELECT item_id AS qid, text AS query FROM {benchmark}"

# (url, last_crawled), (url, date_added): one URL per user
USER_URL = "concat('http://u', CAST(user_id AS STRING), '.example.com:80/')"
URL_SEEN = f"SELECT {USER_URL} AS url, max(ts) AS last_crawled FROM {{events}} GROUP BY 1"
FRONTIER = f"""
SELECT concat({USER_URL}, event_type) AS url, min(ts) AS date_added
FROM {{events}} WHERE event_type <> 'error' GROUP BY 1"""

# (domain, robots_txt, timed_out): rules per user site, several shapes
ROBOTS = """
SELECT DISTINCT concat('http://u', CAST(user_id AS STRING), '.example.com:80') AS domain,
  CASE WHEN user_id < 40 THEN concat('User-agent: *', chr(10), 'Disallow: /view', chr(10), 'Allow: /view/1', chr(10), 'Crawl-delay: 2.5')
       WHEN user_id < 80 THEN concat('User-agent: *', chr(10), 'Disallow: /', chr(10), chr(10), 'User-agent: pagewright', chr(10), 'Disallow: /signup/*5$  # odd', chr(10), 'Crawl-delay: 5')
       WHEN user_id < 110 THEN concat('# none', chr(10), 'User-agent: other', chr(10), 'Disallow: /')
       ELSE concat('User-agent: *', chr(10), 'Disallow:', chr(10), 'Disallow: /*/1') END AS robots_txt,
  user_id > 140 AS timed_out
FROM {events}"""

STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)
SPLIT = r"regexp_split_to_array(lower({0}), '[[:punct:]\s]+')"


def index_tokens_sql(text: str = "text") -> str:
    """Index tokens of (id, text) rows named ``docs``, oracle side."""
    return (
        f"SELECT id, trim(regexp_replace(u.t, '[^\\x01-\\x7F]', '', 'g')) AS term "
        f"FROM docs, unnest({SPLIT.format(text)}) u(t)"
    )


KEPT = f"term <> '' AND length(term) < 50 AND term NOT IN ({STOP_LIST})"

# counts(id, term, n, max_n), oracle side
COUNTS_SQL = f"""
docs AS ({TEXTS}),
tokens AS ({index_tokens_sql()}),
per_term AS (SELECT id, term, count(*) AS n FROM tokens WHERE {KEPT} GROUP BY id, term),
counts AS (SELECT *, max(n) OVER (PARTITION BY id) AS max_n FROM per_term)"""
INDEX_SQL = f"""{COUNTS_SQL},
tf AS (SELECT id, term, 0.5 + 0.5 * n / max_n AS tf FROM counts),
idfs AS (SELECT term, ln((SELECT count(*) FROM docs) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term),
inverted AS (SELECT id, term, tf * idf AS weight FROM tf JOIN idfs USING (term))"""
QUERY_COUNTS_SQL = f"""
queries AS ({QUERIES}),
raw_query AS (SELECT qid, u.t AS term FROM queries, unnest({SPLIT.format('query')}) u(t) WHERE u.t <> ''),
query_tokens AS (SELECT qid, regexp_replace(term, '^[^a-z0-9]+', '') AS term FROM raw_query),
query_n AS (SELECT qid, term, count(*) AS n FROM query_tokens WHERE term <> '' GROUP BY qid, term),
query_counts AS (SELECT *, max(n) OVER (PARTITION BY qid) AS max_n FROM query_n)"""
WEIGHTS_SQL = f"""{INDEX_SQL},{QUERY_COUNTS_SQL},
weights AS (SELECT qid, term, idf, 0.5 + 0.5 * n / max_n * idf AS weight FROM query_counts JOIN idfs USING (term)),
matches AS (SELECT qid, id, w.weight AS q, i.weight AS w FROM inverted i JOIN weights w USING (term)),
norms AS (SELECT qid, sqrt(sum(weight * weight)) AS query_norm FROM weights GROUP BY qid),
dots AS (SELECT qid, id, sum(q * w) AS dot, sqrt(sum(w * w)) AS doc_norm FROM matches GROUP BY qid, id),
cosines AS (SELECT qid, id, dot / nullif(query_norm * doc_norm, 0) AS score FROM dots JOIN norms USING (qid))"""

# page fields by pattern: the pages' markup is regular enough
INLINE = r"</?(?:a|b)(?: [^>]*)?>"
ENTITIES = "replace(replace(replace(replace({0}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
SQUEEZED = "trim(regexp_replace({0}, '[ \\t\\n\\f\\r\\xA0]+', ' ', 'g'))"


def _shown(text: str) -> str:
    return SQUEEZED.format(ENTITIES.format(text))


_NO_TAGS = "regexp_replace({0}, '<[^>]+>', ' ', 'g')"
PAGE_FIELDS_SQL = f"""
bare AS (
  SELECT page_id AS id, url,
    regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'),
      '<(script|style).*?</(script|style)>', '', 'gs'), '{INLINE}', '', 'g') AS h
  FROM {{pages}}),
parts AS (
  SELECT id, url, h, regexp_extract(h, '<title>(.*?)</title>', 1, 's') AS raw_title,
    list_transform(regexp_extract_all(replace(h, '<br>', ' '), '<p>([^<]*)', 1), lambda x: {_shown('x')}) AS paragraphs
  FROM bare),
fields AS (
  SELECT id, url, {_shown('raw_title')} AS title,
    {_shown(_NO_TAGS.format("regexp_extract(h, '<h1>(.*?)</h1>', 1, 's')"))} AS headers,
    list_reduce(list_prepend('', paragraphs), lambda t, p: CASE WHEN length(t) < 300 THEN t || p || ' ' ELSE t END) AS preview,
    {_shown(_NO_TAGS.format("regexp_extract(h, '<body>(.*)$', 1, 's')"))} AS body
  FROM parts)"""
# stored(id, text, headers, title): pages and plain texts, none of which holds a tag
STORED_SQL = f"""{PAGE_FIELDS_SQL},
stored AS (
  SELECT id, title || ' ' || body AS text, headers, title FROM fields
  UNION ALL SELECT doc_id + 1000000, {_shown('text')}, '', '' FROM {{documents}})"""
LINKS_SQL = """
anchors AS (SELECT url AS source, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM {pages}),
normal_links AS (
  SELECT source, regexp_extract(source, '^(https?://[^/]+)', 1)
    || CASE WHEN source LIKE 'https:%' THEN ':443' ELSE ':80' END || href AS dest
  FROM anchors)"""


def best_sql(source: str, k: int) -> str:
    """The ``k`` best rows per query of ``source``, a select of (qid, id, score)."""
    return f"""
WITH {WEIGHTS_SQL}, scored AS ({source}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 12) DESC NULLS LAST, id) AS place FROM scored)
SELECT qid, id, round(score, 6) AS score FROM ranked WHERE place <= {k}"""


# (id, lcs) of the strings (id, a, b) in texts: one step per character of a, a row per character of b
LCS_SQL = """
letters AS (SELECT id, unnest(regexp_extract_all(b, '(?s:.)')) AS letter, generate_subscripts(regexp_extract_all(b, '(?s:.)'), 1) AS j FROM texts),
steps(i, id, j, letter, v) AS (
  SELECT 0, id, j, letter, 0 FROM letters
  UNION ALL
  SELECT i, id, j, letter, CAST(max(c) OVER (PARTITION BY id ORDER BY j) AS INTEGER) FROM (
    SELECT i + 1 AS i, steps.id, j, letter,
      CASE WHEN substr(a, i + 1, 1) = letter THEN 1 + coalesce(lag(v) OVER (PARTITION BY steps.id ORDER BY j), 0) ELSE v END AS c
    FROM steps JOIN texts ON steps.id = texts.id WHERE i < length(a))),
common AS (SELECT id, max(v) AS lcs FROM steps GROUP BY id)"""
