"""Pages read once give the fields and links that separate reads give; plain texts read natively too."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions import html
from pagewright.plans import content

PIECES = ["<a href='/x y'>", "<a href=\"http://b.org/q?a=1&amp;b=2\">", "</a>", "<base href='/z/'>", "<p>", "</p>", "<title>", "</title>",
          "<h1>", "</h1>", "<!-- <a href=no> -->", "<script><a href=no></script>", "&amp;", "word ", "<", "　", "\xa0", "<a href=http://[bad>"]
TEXTS = ["", " ", "a  b", "\t a\n\nb \xa0", "a & b", "&amp;", "1 < 2", "<b>x</b>", "　x　", "x\x0b", "\x85x", "\x1fx\x1c", "é \r\n ü", " x", "plain " * 50_000, None]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
def test_one_pass_equals_two(page):
    url = "http://a.com/b/c"
    assert html.read_page(url, page) == (*html.read_fields(page), html.read_links(url, page))
    assert html.read_page(None, page) == (*html.read_fields(page), [])


def test_native_plain_texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(4)
    fields = html.page_fields(F.col("text")).alias("page")
    got = {r.id: (r.page.title, r.page.headers, r.page.paragraphs, r.page.body) for r in df.select("id", fields).collect()}
    assert got == {i: html.read_fields(text or "") for i, text in enumerate(TEXTS)}


def test_tables_of_one_read(spark):
    page = "<title>T</title><h1>H</h1><p>one<a href='/n'>two</a></p>"
    docs = spark.createDataFrame(
        [(1, "http://a.com/", page, "text/html"), (2, "http://t.com/2", "just  text", "text/plain"), (3, None, page, "text/html"),
         (4, "http://a.com/4", None, "text/html"), (5, "http://a.com/5", page, "text/plain")],
        "id long, url string, content string, type string",
    )
    read = content.read_pages(docs)

    def rows(df):
        return sorted(map(tuple, df.collect()))

    assert rows(content.content_of(read)) == rows(content.page_content(docs))
    assert rows(content.texts_of(read)) == rows(content.page_texts(docs))
    assert rows(content.links_of(read)) == rows(content.extract_links(docs.withColumnRenamed("content", "document")))
    assert content.links_of(read).count() == 1


def test_one_parse_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "http://a.com/", "<p>x", "text/html")], "id long, url string, content string, type string")
    plan = content.read_pages(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython") == 1
