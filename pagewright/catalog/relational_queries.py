"""Joins, set operations, aggregates, windows and limits."""

from pyspark.sql import functions as F

from pagewright.catalog import inputs as I
from pagewright.catalog.registry import query
from pagewright.operators import frontier, tables
from pagewright.operators.scale import positions, salted_lookup, top_k_per_group
from pagewright.plans import index, pagerank, search
from pagewright.session import stage

# ---- joins ------------------------------------------------------------------------------------


@query("J1_referential_links", f"""
WITH links AS ({I.LINKS}), urls AS ({I.URLS})
SELECT source, dest FROM links WHERE source IN (SELECT url FROM urls) AND dest IN (SELECT url FROM urls) AND source <> dest""")
def _(t):
    return pagerank.crawled_links(t.sql(I.LINKS), t.sql(I.URLS))


@query("J2_sink_detection", f"""
WITH e AS ({I.EDGES}) SELECT DISTINCT dest AS sink FROM e WHERE dest NOT IN (SELECT source FROM e)""")
def _(t):
    return pagerank.sinks(t.sql(I.EDGES))


BACK = "SELECT dest AS source, source AS dest FROM e WHERE dest NOT IN (SELECT source FROM e)"


@query("J3_back_edges", f"WITH e AS ({I.EDGES}) {BACK}")
def _(t):
    edges = stage(t.sql(I.EDGES), "edges")
    return pagerank.back_edges(edges, pagerank.sinks(edges))


@query("J4_rank_join", f"""
WITH e AS ({I.EDGES}), w AS (SELECT source, 1.0 / count(*) AS out_weight FROM e GROUP BY source),
r AS (SELECT p_partkey AS node, p_retailprice / 1000 AS rank FROM part)
SELECT e.source, e.dest, round(out_weight * rank, 8) AS share FROM e JOIN w USING (source) JOIN r ON e.source = r.node""")
def _(t):
    edges = stage(t.sql(I.EDGES), "edges")
    ranks = t.part.select(F.col("p_partkey").alias("source"), (F.col("p_retailprice") / 1000).alias("rank"))
    shares = pagerank.out_weights(edges).join(ranks, "source")
    sent = salted_lookup(edges, shares, "source", "inner", ["dest"])
    return sent.select("source", "dest", F.round(F.col("out_weight") * F.col("rank"), 8).alias("share"))


@query("J5_iteration_diff_join", """
WITH before AS (SELECT l_partkey AS node, max(l_quantity) AS before FROM lineitem GROUP BY 1),
after AS (SELECT o_custkey AS node, max(o_totalprice) AS after FROM orders GROUP BY 1)
SELECT node, round(abs(before - after), 8) AS diff FROM before JOIN after USING (node)""")
def _(t):
    before = t.lineitem.groupBy(F.col("l_partkey").alias("node")).agg(F.max("l_quantity").alias("before"))
    after = t.orders.groupBy(F.col("o_custkey").alias("node")).agg(F.max("o_totalprice").alias("after"))
    return before.join(after, "node").select("node", F.round(F.abs(F.col("before") - F.col("after")), 8).alias("diff"))


@query("J6_postings_idf", f"WITH {I.INDEX_SQL} SELECT id, term, round(tf, 8) AS tf, round(idf, 8) AS idf FROM tf JOIN idfs USING (term)")
def _(t):
    docs = t.sql(I.TEXTS)
    joined, _ = index.postings_with_idf(index.term_counts(docs, stem=False), docs.count(), index.SMOOTHING)
    return joined.select("id", "term", F.round("tf", 8).alias("tf"), F.round("idf", 8).alias("idf"))


@query("J7_score_document_rank", """
WITH scores AS (SELECT o_custkey AS qid, o_orderkey AS id, o_totalprice / 100000 AS score FROM orders),
ranks AS (SELECT l_partkey AS id, sum(l_discount) AS rank FROM lineitem GROUP BY 1)
SELECT qid, id, round(score + rank, 8) AS score FROM scores JOIN ranks USING (id)""")
def _(t):
    scores = t.orders.select(
        F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 100000).alias("score")
    )
    ranks = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(F.sum("l_discount").alias("rank"))
    return search.with_document_rank(scores, ranks).select("qid", "id", F.round("score", 8).alias("score"))


@query("J8_enrich_candidates", """
WITH candidates AS (SELECT user_id AS qid, event_id AS id, value AS score FROM events),
hosts AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS domain, count(*) / 100.0 AS rank FROM pages WHERE url LIKE 'http:%' GROUP BY 1)
SELECT qid, c.id, score, url, url AS title, html AS preview, p.url IS NOT NULL AS has_content, rank AS domain_rank
FROM candidates c LEFT JOIN pages p ON c.id = p.page_id LEFT JOIN hosts ON domain = regexp_extract(p.url, '^https?://([^/]+)', 1)""")
def _(t):
    candidates = t.events.select(F.col("user_id").alias("qid"), F.col("event_id").alias("id"), F.col("value").alias("score"))
    urls = t.pages.select(F.col("page_id").alias("id"), "url")
    content = urls.join(t.pages.select(F.col("page_id").alias("id"), F.col("html").alias("content")), "id").select(
        "id", F.col("url").alias("title"), "content", F.lit("").alias("headers")
    )
    ranks = (
        t.pages.where("url LIKE 'http:%'").groupBy(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("domain"))
        .agg((F.count("*") / 100.0).alias("rank"))
    )
    rows = search.enrich(candidates, urls, content, ranks)
    return rows.select(
        "qid", "id", "score", "url", "title", "preview", F.coalesce("has_content", F.lit(False)).alias("has_content"), "domain_rank"
    )


@query("J9_documents_with_url", """
SELECT page_id AS id, url, html AS content, 'text/html' AS type FROM pages WHERE page_id IN (SELECT doc_id FROM labels)""")
def _(t):
    docs = t.pages.select(F.col("page_id").alias("id"), F.col("html").alias("content"), F.lit("text/html").alias("type"))
    urls = t.pages.select(F.col("page_id").alias("id"), "url").join(
        t.labels.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi"
    )
    return tables.lookup_documents(docs, urls, F.lit(True))


@query("J11_url_seen_join", f"""
WITH log AS ({I.FETCH_LOG}), seen AS (SELECT url, max(fetched_at) AS last_crawled FROM log WHERE status < 400 GROUP BY url)
SELECT l.id, l.url, s.last_crawled, s.url IS NOT NULL AS known FROM log l LEFT JOIN seen s USING (url)""")
def _(t):
    log = stage(t.sql(I.FETCH_LOG), "fetch-log")
    seen = log.where("status < 400").groupBy("url").agg(F.max("fetched_at").alias("last_crawled"))
    joined = salted_lookup(log.select("id", "url"), seen, "url", "left", ["id"])
    return joined.select("id", "url", "last_crawled", F.col("last_crawled").isNotNull().alias("known"))


@query("J12_add_if_absent", f"""
WITH queued AS ({I.FRONTIER}) SELECT DISTINCT {I.USER_URL} || event_type AS url FROM events
WHERE {I.USER_URL} || event_type NOT IN (SELECT url FROM queued)""")
def _(t):
    new = t.sql(f"SELECT concat({I.USER_URL}, event_type) AS url FROM {{events}}")
    return tables.absent(new, t.sql(I.FRONTIER), ["url"])


REPAIRED = f"e AS ({I.EDGES}), repaired AS ({BACK} UNION SELECT source, dest FROM e)"


@query("U1_distinct_union", f"WITH {REPAIRED} SELECT source, dest FROM repaired")
def _(t):
    return pagerank.repair_sinks(stage(t.sql(I.EDGES), "edges"))


@query("U2_distinct_pairs", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


# ---- aggregates -------------------------------------------------------------------------------


@query("A1_term_counts", f"WITH {I.COUNTS_SQL} SELECT id, term, n FROM counts")
def _(t):
    return index.term_counts(t.sql(I.TEXTS), stem=False).select("id", "term", "n")


@query("A2_max_term_count", f"WITH {I.COUNTS_SQL} SELECT DISTINCT id, max_n FROM counts")
def _(t):
    return index.term_counts(t.sql(I.TEXTS), stem=False).select("id", "max_n").distinct()


@query("A3_document_frequency", f"WITH {I.COUNTS_SQL} SELECT term, count(*) AS df FROM counts GROUP BY term")
def _(t):
    return index.document_frequencies(index.term_counts(t.sql(I.TEXTS), stem=False))


@query("A4_corpus_size", f"SELECT count(*) AS n_docs FROM ({I.CRAWLER_DOCS})")
def _(t):
    return t.sql(I.CRAWLER_DOCS).agg(F.count("*").alias("n_docs"))


@query("A5_out_weights", f"WITH e AS ({I.EDGES}) SELECT source, round(1.0 / count(*), 8) AS out_weight FROM e GROUP BY source")
def _(t):
    return pagerank.out_weights(t.sql(I.EDGES)).select("source", F.round("out_weight", 8).alias("out_weight"))


@query("A6_rank_sum", "SELECT l_partkey AS node, round(sum(l_discount) * 0.85 + 0.15, 8) AS rank FROM lineitem GROUP BY 1")
def _(t):
    sent = t.lineitem.select(F.col("l_partkey").alias("dest"), F.col("l_discount").alias("share"))
    return pagerank.received(sent).select("node", F.round("rank", 8).alias("rank"))


@query("A7_max_change", """
WITH p AS (SELECT c_custkey AS node, c_acctbal AS rank FROM customer), c AS (SELECT o_custkey AS node, sum(o_totalprice) / 1000 AS rank FROM orders GROUP BY 1)
SELECT round(max(abs(p.rank - c.rank)), 6) AS max_diff FROM p JOIN c USING (node)""")
def _(t):
    before = t.customer.select(F.col("c_custkey").alias("node"), F.col("c_acctbal").alias("rank"))
    after = t.orders.groupBy(F.col("o_custkey").alias("node")).agg((F.sum("o_totalprice") / 1000).alias("rank"))
    return pagerank.rank_change(before, after).select(F.round("max_diff", 6).alias("max_diff"))


@query("A8_rank_statistics", """
SELECT round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders""")
def _(t):
    price = F.col("o_totalprice")
    return t.orders.agg(
        F.round(F.avg(price), 4).alias("mean"), F.round(F.stddev_samp(price), 4).alias("std"),
        F.min(price).alias("low"), F.max(price).alias("high"),
    )


@query("A9_document_vectors", f"""
WITH {I.WEIGHTS_SQL}, vectors AS (SELECT qid, id, count(*) AS terms, sum(q * w) AS dot, sum(w * w) AS squared FROM matches GROUP BY qid, id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dot, 12) DESC NULLS LAST, id) AS place FROM vectors)
SELECT qid, id, terms, round(dot, 6) AS dot, round(squared, 6) AS squared FROM ranked WHERE place <= 100""")
def _(t):
    inverted, idfs = index.build_index(t.sql(I.TEXTS), stem=False)
    weights = search.query_weights(search.query_counts(t.sql(I.QUERIES), stem=False), idfs)
    q, w = F.col("q"), F.col("w")
    vectors = search.matching_postings(inverted, weights).groupBy("qid", "id").agg(
        F.count("*").alias("terms"), F.sum(q * w).alias("dot"), F.sum(w * w).alias("squared")
    )
    best = top_k_per_group(vectors, ["qid"], search.by_score("dot"), search.EARLY_CANDIDATES, "id")
    return best.select("qid", "id", "terms", F.round("dot", 6).alias("dot"), F.round("squared", 6).alias("squared"))


@query("A10_query_term_frequency", f"WITH {I.QUERY_COUNTS_SQL} SELECT qid, term, n, max_n, round(n / max_n, 8) AS tf FROM query_counts")
def _(t):
    counts = search.query_counts(t.sql(I.QUERIES), stem=False)
    return counts.withColumn("tf", F.round(F.col("n") / F.col("max_n"), 8))


POLLS = """SELECT date_trunc('day', ts) AS polled_at, CAST(count(*) AS BIGINT) AS docs FROM {events} GROUP BY 1"""


@query("A11_crawl_progress", f"""
WITH polls AS ({POLLS})
SELECT CAST(polled_at AS TIMESTAMP) AS polled_at, docs, docs >= 340 OR coalesce(docs = lag(docs) OVER (ORDER BY polled_at), false) AS stop FROM polls""")
def _(t):
    polls = t.sql(POLLS).withColumn("polled_at", F.col("polled_at").cast("timestamp_ntz"))
    return frontier.crawl_progress(polls, 340)


# ---- windows and limits -----------------------------------------------------------------------


@query("W1_result_dedupe", """
WITH rows AS (SELECT user_id AS qid, event_id AS id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS title,
  CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) AS preview, value AS score FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid, title, preview ORDER BY score DESC, id) AS copy FROM rows)
SELECT qid, id, title, preview, score FROM ranked WHERE title = '' OR preview = '' OR copy = 1""")
def _(t):
    rows = t.events.select(
        F.col("user_id").alias("qid"), F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("title"),
        F.floor(F.col("value") / 10).cast("string").alias("preview"), F.col("value").alias("score"),
    )
    return search.without_repeats(rows, [F.col("score").desc(), F.col("id")])


@query("T1_top_k", "SELECT o_orderkey AS id, o_totalprice AS score FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2000")
def _(t):
    return search.best(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score")), 2000)


@query("T2_final_order", """
SELECT o_custkey AS qid, o_orderkey AS id, o_totalprice AS score,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders""")
def _(t):
    rows = t.orders.select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"))
    # a customer may have any number of orders, so the whole order is taken by range, not in one window
    placed = positions(rows.withColumn("down", -F.col("score")), ["down", "id"], group="qid")
    return placed.select("qid", "id", "score", F.col("position").cast("int").alias("rank"))


@query("T3_oldest_first", f"SELECT url, date_added FROM ({I.FRONTIER}) ORDER BY date_added, url LIMIT 100")
def _(t):
    return frontier.oldest_first(t.sql(I.FRONTIER), 100)
