"""Sources, sinks and table upserts."""

from pyspark.sql import functions as F

from pagewright.catalog import inputs as I
from pagewright.catalog.registry import query
from pagewright.functions.text import index_terms
from pagewright.operators import tables as ops
from pagewright.plans.search import as_json
from pagewright.session import scratch_path
from pagewright.sources import tables as src
from pagewright.sources import wordlist


@query("S1_table_scan", "SELECT doc_id, lang, n_chars FROM documents")
def _(t):
    return src.read_table(t.spark, f"{t.folder}/documents.parquet", 8).select("doc_id", "lang", "n_chars")


# links between two different pages that were both crawled
INNER_LINKS = """
SELECT link.source, link.dest FROM {links} link
WHERE link.dest <> link.source
  AND EXISTS (SELECT 1 FROM {urls} page WHERE page.url = link.source)
  AND EXISTS (SELECT 1 FROM {urls} page WHERE page.url = link.dest)"""


@query("S2_pushed_query", f"WITH links AS ({I.LINKS}), urls AS ({I.URLS}) "
       + INNER_LINKS.format(links="links", urls="urls"))
def _(t):
    return src.read_query(t.spark, INNER_LINKS, links=t.sql(I.LINKS), urls=t.sql(I.URLS))


@query("S3_key_lookup", """SELECT doc_id, source, n_chars FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""")  # fmt: skip
def _(t):
    return ops.by_keys(t.documents, t.labels.where("toxic = 1"), "doc_id", ["doc_id", "source", "n_chars"])


@query("S3_stored_key_lookup", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (1, 7, 100, 999, 5000)""")  # fmt: skip
def _(t):
    path = scratch_path(t.spark, "sorted")
    src.write_sorted(t.lineitem, path, "l_orderkey", "l_linenumber")
    return src.lookup(t.spark, path, "l_orderkey", [1, 7, 100, 999, 5000], ["l_orderkey", "l_linenumber", "l_quantity"])


@query("S4_overwrite_keep_definition", "SELECT c_custkey AS id, c_acctbal AS balance FROM customer")
def _(t):
    path = scratch_path(t.spark, "overwrite")
    src.recreate_table(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")), path)
    customers = t.customer.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_acctbal").alias("balance"))
    return src.overwrite_table(customers, path)


@query("S5_drop_and_recreate", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    path = scratch_path(t.spark, "recreate")
    src.recreate_table(t.nation, path)
    return src.recreate_table(t.supplier.select("s_suppkey", "s_name"), path)


KNOWN_PAGES = "SELECT page_id + 1 AS id, url FROM {pages} WHERE url LIKE 'https:%'"


@query("S6_url_dictionary_upsert", f"""
WITH known AS ({KNOWN_PAGES}), fresh AS (SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM known))
SELECT id, url FROM known UNION ALL
SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY url) AS id, url FROM fresh""")
def _(t):
    return ops.upsert_urls(t.sql(KNOWN_PAGES), t.pages)


@query("S7_document_upsert", """
WITH updates AS (SELECT conv_id AS id, text AS content, role AS type, turn FROM conversations),
winners AS (SELECT id, arg_max(content, turn) AS content, arg_max(type, turn) AS type FROM updates GROUP BY id)
SELECT id, content, type FROM winners UNION ALL
SELECT doc_id, text, lang FROM documents WHERE doc_id NOT IN (SELECT id FROM winners)""")
def _(t):
    current = t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("content"), F.col("lang").alias("type"))
    updates = t.conversations.select(
        F.col("conv_id").alias("id"), F.col("text").alias("content"), F.col("role").alias("type"), "turn"
    )
    return ops.upsert_docs(current, updates, "turn")


@query("S8_link_insert_ignore", f"""
WITH current AS ({I.EDGES}), new AS (SELECT l_partkey AS source, l_partkey + l_suppkey AS dest FROM lineitem
  UNION ALL SELECT * FROM current)
SELECT * FROM current UNION SELECT * FROM new""")
def _(t):
    current = t.sql(I.EDGES)
    new = t.lineitem.select(F.col("l_partkey").alias("source"), (F.col("l_partkey") + F.col("l_suppkey")).alias("dest"))
    return ops.insert_links(current, new.unionByName(current))


@query("S9_word_list", f"""
WITH words AS (SELECT DISTINCT u.t AS word FROM benchmark, unnest({I.SPLIT.format('text')}) u(t)),
docs AS ({I.TEXTS}), tokens AS ({I.index_tokens_sql()})
SELECT id, term FROM tokens WHERE {I.KEPT} AND term NOT IN (SELECT word FROM words)""")
def _(t):
    path = scratch_path(t.spark, "words")
    split = F.explode(F.split(F.lower("text"), r"[\p{Punct}\s]+"))
    t.benchmark.select(split.alias("value")).distinct().write.text(path)
    terms = t.documents.select(F.col("doc_id").alias("id"), F.explode(index_terms(F.col("text"))).alias("term"))
    return wordlist.without_words(terms, wordlist.read_word_list(t.spark, path))


@query("S10_document_by_url", """
SELECT page_id AS id, url, html AS content, 'text/html' AS type FROM pages WHERE url LIKE 'http:%'""")
def _(t):
    docs = t.pages.select(F.col("page_id").alias("id"), F.col("html").alias("content"), F.lit("text/html").alias("type"))
    urls = t.pages.select(F.col("page_id").alias("id"), "url")
    return ops.lookup_documents(docs, urls, urls.where("url LIKE 'http:%'"))


@query("S11_json_rows", """
SELECT page_id AS qid, page_id AS rank,
  to_json({'url': url, 'title': url, 'preview': '', 'headers': '', 'score': page_id / 4.0}) AS json FROM pages""")
def _(t):
    return as_json(
        t.pages.select(
            F.col("page_id").alias("qid"), F.col("page_id").alias("rank"), "url", F.col("url").alias("title"),
            F.lit("").alias("preview"), F.lit("").alias("headers"), (F.col("page_id") / 4.0).alias("score"),
        )
    )
