"""Index build and search jobs."""

from pyspark.sql import functions as F

from pagewright.catalog import inputs as I
from pagewright.catalog.registry import query
from pagewright.catalog.stem_sql import stems_sql
from pagewright.functions.text import raw_terms
from pagewright.plans import blocks, content, index, pagerank, search
from pagewright.session import stage


def text_index(t, stem=False):
    return index.build_index(t.sql(I.TEXTS), stem=stem)


@query("X1_inverted_index", f"WITH {I.INDEX_SQL} SELECT id, term, round(weight, 8) AS weight FROM inverted")
def _(t):
    inverted, _ = text_index(t)
    return inverted.select("id", "term", F.round("weight", 8).alias("weight"))


@query("X1_idfs", f"WITH {I.INDEX_SQL} SELECT term, round(idf, 8) AS idf FROM idfs")
def _(t):
    _, idfs = text_index(t)
    return idfs.select("term", F.round("idf", 8).alias("idf"))


@query("X1_stemmed_page_index", f"""
WITH {I.STORED_SQL}, docs AS (SELECT id, text FROM stored), tokens AS ({I.index_tokens_sql()}),
kept AS (SELECT id, term FROM tokens WHERE {I.KEPT}), {stems_sql('kept')},
per_term AS (SELECT id, stem AS term, count(*) AS n FROM kept JOIN stems USING (term) GROUP BY id, stem),
tf AS (SELECT id, term, 0.5 + 0.5 * n / max(n) OVER (PARTITION BY id) AS tf FROM per_term),
idfs AS (SELECT term, ln((SELECT count(*) FROM docs) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term)
SELECT id, term, round(tf * idf, 8) AS weight FROM tf JOIN idfs USING (term)""")
def _(t):
    inverted, _ = index.build_index(content.page_texts(t.sql(I.CRAWLER_DOCS)))
    return inverted.select("id", "term", F.round("weight", 8).alias("weight"))


# the page form of the index without stems: every stored document counts
@query("X1_page_index", f"""
WITH {I.STORED_SQL}, docs AS (SELECT id, text FROM stored), tokens AS ({I.index_tokens_sql()}),
per_term AS (SELECT id, term, count(*) AS n FROM tokens WHERE {I.KEPT} GROUP BY id, term),
tf AS (SELECT id, term, 0.5 + 0.5 * n / max(n) OVER (PARTITION BY id) AS tf FROM per_term),
idfs AS (SELECT term, ln((SELECT count(*) FROM docs) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term)
SELECT id, term, round(tf * idf, 8) AS weight FROM tf JOIN idfs USING (term)""")
def _(t):
    inverted, _ = index.build_index(content.page_texts(t.sql(I.CRAWLER_DOCS)), stem=False)
    return inverted.select("id", "term", F.round("weight", 8).alias("weight"))


FIELD_COUNTS_SQL = f"""{I.STORED_SQL},
boosted AS (
  SELECT id, u.t AS raw, 1 AS boost FROM stored, unnest({I.SPLIT.format('text')}) u(t)
  UNION ALL SELECT id, u.t, 4 FROM stored, unnest({I.SPLIT.format('headers')}) u(t)
  UNION ALL SELECT id, u.t, 10 FROM stored, unnest({I.SPLIT.format('title')}) u(t)),
field_terms AS (SELECT id, regexp_replace(raw, '^[^a-z0-9]+', '') AS term, boost FROM boosted WHERE raw <> ''),
field_n AS (SELECT id, term, sum(boost) AS n FROM field_terms WHERE term <> '' AND term NOT IN ({I.STOP_LIST}) GROUP BY id, term),
field_tf AS (SELECT id, term, 0.4 + 0.6 * n / max(n) OVER (PARTITION BY id) AS tf FROM field_n),
field_idf AS (SELECT term, ln((SELECT count(*) FROM stored) / (count(*) + 1.0)) AS idf FROM field_tf GROUP BY term)"""


@query("X2_field_weighted_index", f"""
WITH {FIELD_COUNTS_SQL} SELECT id, term, round(tf * idf, 8) AS weight FROM field_tf JOIN field_idf USING (term)""")
def _(t):
    inverted, _ = index.build_field_index(content.field_texts(t.sql(I.CRAWLER_DOCS)), stem=False)
    return inverted.select("id", "term", F.round("weight", 8).alias("weight"))


def found_by(t, k, scorer="cosine", ranks=None):
    """The ``k`` best documents per query, by block-max retrieval."""
    built, idfs = blocks.build_block_index(t.sql(I.TEXTS), stem=False)
    found = search.search_scored(t.sql(I.QUERIES), built, idfs, k, scorer, stem=False, ranks=ranks)
    return found.select("qid", "id", F.round("score", 6).alias("score"))


# so many of the documents that no block could stay closed: the plain index
@query("X3_search_cosine", I.best_sql("SELECT * FROM cosines", 2000))
def _(t):
    inverted, idfs = text_index(t)
    found = search.search_scored(t.sql(I.QUERIES), inverted, idfs, search.CANDIDATES, stem=False)
    return found.select("qid", "id", F.round("score", 6).alias("score"))


# a k that cuts every query's matches
@query("X3_search_cosine_top_50", I.best_sql("SELECT * FROM cosines", 50))
def _(t):
    return found_by(t, 50)


@query("X4_search_dot_product", I.best_sql("SELECT qid, id, dot AS score FROM dots", 100))
def _(t):
    return found_by(t, search.EARLY_CANDIDATES, "dot")


@query("X5_search_cosine_plus_rank", I.best_sql(
    "SELECT qid, c.id, score + quality / 4.0 AS score FROM cosines c JOIN labels ON doc_id = c.id", 100))
def _(t):
    ranks = t.labels.select(F.col("doc_id").alias("id"), (F.col("quality") / 4.0).alias("rank"))
    return found_by(t, search.EARLY_CANDIDATES, ranks=ranks)


@query("X6_blended_score", """
SELECT event_id AS id, round(0.013 * ln(greatest(coalesce(c_acctbal / 10000, 0.00001), 0.1)) + 0.987 * value, 8) AS score
FROM events LEFT JOIN customer ON user_id = c_custkey""")
def _(t):
    rows = t.events.join(t.customer, F.col("user_id") == F.col("c_custkey"), "left")
    score = search.blended_score(F.col("value"), F.col("c_acctbal") / 10000)
    return rows.select(F.col("event_id").alias("id"), F.round(score, 8).alias("score"))


# (qid, id, query, title, headers, preview): every page against the title of its host's first page
PAIRS_SQL = f"""
WITH {I.PAGE_FIELDS_SQL}, hosts AS (SELECT *, regexp_extract(url, '//([^/]+)', 1) AS host FROM fields),
asked AS (SELECT host, min(title) AS query FROM hosts GROUP BY host),
pairs AS (SELECT id, lower(query) AS query, title, headers, preview FROM hosts JOIN asked USING (host))"""


def pairs(t):
    # read by the pairs and by the query texts, so parsed once
    parsed = stage(content.page_content(t.sql(I.CRAWLER_DOCS)), "content")
    fields = parsed.withColumnRenamed("content", "preview")
    urls = t.pages.select(F.col("page_id").alias("id"), F.regexp_extract("url", "//([^/]+)", 1).alias("host"))
    hosts = fields.join(urls, "id")
    asked = hosts.groupBy("host").agg(F.min("title").alias("query"))
    return hosts.join(asked, "host").withColumn("query", F.lower("query"))


def details(rows):
    terms = rows.withColumn("terms", raw_terms(F.col("query")))
    idf = F.map_from_arrays(F.array_distinct("terms"), F.transform(F.array_distinct("terms"), lambda w: F.length(w) / 10))
    return terms.withColumn("idf", idf).withColumn("stems", search.stem_all(F.col("terms")))


def term_bonus_query(name: str, field: str, strict: bool = False, sql: str | None = None):
    @query(name, sql)
    def _(t):
        earned = search.term_bonus(field, F.col(field), F.col("terms"), F.col("stems"), F.col("idf"), strict)
        return details(pairs(t)).select("id", F.round(earned, 8).alias("bonus"))


def term_bonuses_sql(header_part: float, header_tested: bool) -> str:
    """``earned`` (id, field, bonus): what the query's terms earn in the title and the headers."""
    return f"""
page_words AS (
  SELECT id, 'title' AS field, unnest({I.SPLIT.format('title')}) AS term FROM pairs
  UNION ALL SELECT id, 'headers', unnest({I.SPLIT.format('headers')}) FROM pairs),
asked_terms AS (SELECT id, unnest({I.SPLIT.format('query')}) AS term FROM pairs),
all_words AS (SELECT term FROM page_words UNION ALL SELECT term FROM asked_terms), {stems_sql('all_words')},
page_terms AS (SELECT DISTINCT id, field, term FROM page_words),
page_stems AS (SELECT DISTINCT id, field, stem FROM page_words JOIN stems USING (term)),
values_of(field, exact, part, tested) AS (
  VALUES ('title', CAST(0.01 AS DOUBLE), CAST(0.003 AS DOUBLE), true),
    ('headers', CAST(0.005 AS DOUBLE), CAST({header_part} AS DOUBLE), {header_tested})),
earned AS (
  SELECT a.id, v.field, sum(CASE WHEN t.term IS NOT NULL THEN exact
    WHEN s.stem IS NOT NULL OR NOT tested THEN part * length(a.term) / 10 ELSE 0 END) AS bonus
  FROM asked_terms a JOIN stems q USING (term) CROSS JOIN values_of v
  LEFT JOIN page_terms t ON t.id = a.id AND t.field = v.field AND t.term = a.term
  LEFT JOIN page_stems s ON s.id = a.id AND s.field = v.field AND s.stem = q.stem
  WHERE a.term <> '' GROUP BY a.id, v.field)"""


def term_bonus_sql(field: str, header_part: float, header_tested: bool) -> str:
    return f"""{PAIRS_SQL}, {term_bonuses_sql(header_part, header_tested)}
SELECT p.id, round(coalesce(bonus, 0.0), 8) AS bonus FROM pairs p LEFT JOIN earned e ON e.id = p.id AND field = '{field}'"""


term_bonus_query("X7_title_term_bonus", "title", sql=term_bonus_sql("title", 0.003, False))
# by default no stem is tested in headers: each term that is not met earns the stem bonus
term_bonus_query("X10_header_term_bonus", "headers", sql=f"""{PAIRS_SQL},
asked_terms AS (SELECT id, unnest({I.SPLIT.format('query')}) AS term, {I.SPLIT.format('headers')} AS words FROM pairs),
earned AS (SELECT id, sum(CASE WHEN list_contains(words, term) THEN 0.005 ELSE CAST(0.003 AS DOUBLE) * length(term) / 10 END) AS bonus
  FROM asked_terms WHERE term <> '' GROUP BY id)
SELECT id, round(coalesce(bonus, 0.0), 8) AS bonus FROM pairs LEFT JOIN earned USING (id)""")
term_bonus_query("X10_header_term_bonus_strict", "headers", strict=True, sql=term_bonus_sql("headers", 0.0015, True))


def sequence_query(name: str, field: str, factor: float):
    sql = f"""{PAIRS_SQL.replace("WITH", "WITH RECURSIVE", 1)}, texts AS (SELECT id, query AS a, lower({field}) AS b FROM pairs), {I.LCS_SQL}
SELECT id, round(CASE WHEN coalesce(lcs, 0) >= 0.9 * length(query) AND query <> '' THEN ln(length(query)) * {factor} * lcs / length(query) ELSE 0.0 END, 8) AS bonus
FROM pairs LEFT JOIN common USING (id)"""

    @query(name, sql)
    def _(t):
        earned = search.sequence_bonus(field, F.col(field), F.col("query"))
        return pairs(t).select("id", F.round(earned, 8).alias("bonus"))


sequence_query("X8_title_sequence_bonus", "title", 0.06)
sequence_query("X11_header_sequence_bonus", "headers", 0.03)


def contains_query(name: str, field: str, factor: float):
    sql = f"{PAIRS_SQL} SELECT id, round(CASE WHEN contains(lower({field}), query) THEN ln(length(query)) * {factor} ELSE 0.0 END, 8) AS bonus FROM pairs"

    @query(name, sql)
    def _(t):
        earned = search.contains_bonus(field, F.col(field), F.col("query"))
        return pairs(t).select("id", F.round(earned, 8).alias("bonus"))


contains_query("X9_title_contains_bonus", "title", 0.04)
contains_query("X12_header_contains_bonus", "headers", 0.02)
contains_query("X13_preview_contains_bonus", "preview", 0.04)


@query("X14_missing_content", """
SELECT p.page_id AS id, url, CASE WHEN doc_id IS NULL THEN url ELSE coalesce(html, '') END AS title,
  '' AS preview, '' AS headers, doc_id IS NOT NULL AS has_content
FROM pages p LEFT JOIN labels ON doc_id = page_id AND toxic = 0""")
def _(t):
    known = t.labels.where("toxic = 0").select(F.col("doc_id").alias("page_id"), F.lit(True).alias("has_content"))
    rows = t.pages.join(known, "page_id", "left").select(
        F.col("page_id").alias("id"), "url", F.col("html").alias("title"), "has_content",
        F.lit(None).cast("string").alias("preview"), F.lit(None).cast("string").alias("headers"),
    )
    return search.with_fallback(rows)


def page_search(t, **options):
    """All stored documents as a corpus, one query per host, PageRank of the hosts that share a path.

    Plain texts have no content row, so their results show the URL.
    """
    # pages are parsed once; content, texts, links and URLs are columns of the stored result
    read = stage(content.read_pages(t.sql(I.STORED_DOCS)), "pages")
    parsed = stage(content.content_of(read), "content")
    inverted, idfs = index.build_index(content.texts_of(read))
    inverted = stage(inverted, "index")
    urls = read.select("id", "url")
    pages = urls.join(parsed.select("id"), "id", "left_semi")
    host = F.regexp_extract("url", "//([^/]+)", 1)
    asked = pages.join(parsed, "id").groupBy(host.alias("host")).agg(
        F.min("id").alias("qid"), F.min("title").alias("query")
    )
    # hosts whose pages link to the same path, in the order of their names
    links = content.links_of(read).select(
        F.regexp_extract("source", "//([^/]+)", 1).alias("host"), F.regexp_extract("dest", "//[^/]+(/.*)$", 1).alias("path")
    ).distinct()
    first = links.groupBy("path").agg(F.min("host").alias("dest"))
    edges = links.join(first, "path").select(F.col("host").alias("source"), "dest").where("source <> dest").distinct()
    ranks = pagerank.pagerank(edges)
    return search.search(asked.select("qid", "query"), inverted, idfs, urls, parsed, ranks, **options)


@query("X15_full_search")
def _(t):
    found = page_search(t)
    return found.withColumn("score", F.round("score", 8))


def _sequence_sql(shared: str, factor: float) -> str:
    return f"CASE WHEN coalesce({shared}, 0) >= 0.9 * length(query) THEN ln(length(query)) * {factor} * {shared} / length(query) ELSE 0.0 END"


def _contains_sql(field: str, factor: float) -> str:
    return f"CASE WHEN contains(lower({field}), query) THEN ln(length(query)) * {factor} ELSE 0.0 END"


# the subsequences of titles and headers are worked out under even and odd numbers
X16_SQL = f"""{PAIRS_SQL.replace("WITH", "WITH RECURSIVE", 1)}, {term_bonuses_sql(0.003, False)},
texts AS (
  SELECT 2 * id AS id, query AS a, lower(title) AS b FROM pairs
  UNION ALL SELECT 2 * id + 1, query, lower(headers) FROM pairs), {I.LCS_SQL}
SELECT p.id, round(1.0
  + CASE WHEN title <> '' THEN coalesce(te.bonus, 0.0) + {_sequence_sql('tc.lcs', 0.06)} + {_contains_sql('title', 0.04)} ELSE 0.0 END
  + CASE WHEN headers <> '' THEN coalesce(he.bonus, 0.0) + {_sequence_sql('hc.lcs', 0.03)} + {_contains_sql('headers', 0.02)} ELSE 0.0 END
  + CASE WHEN preview <> '' THEN {_contains_sql('preview', 0.04)} ELSE 0.0 END, 8) AS score
FROM pairs p
LEFT JOIN earned te ON te.id = p.id AND te.field = 'title' LEFT JOIN common tc ON tc.id = 2 * p.id
LEFT JOIN earned he ON he.id = p.id AND he.field = 'headers' LEFT JOIN common hc ON hc.id = 2 * p.id + 1"""


@query("X16_bonus_rescoring", X16_SQL)
def _(t):
    rows = details(pairs(t)).select(
        F.col("id").alias("qid"), "id", "title", "headers", "preview", "query", "terms", "stems", F.col("idf").alias("idf_of")
    )
    pages = rows.select("qid", "id", "title", "headers", "preview", F.lit(1.0).alias("score"))
    scored = search.rescore(pages, rows.select("qid", "query", "terms", "stems", "idf_of"))
    return scored.select("id", F.round("score", 8).alias("score"))
