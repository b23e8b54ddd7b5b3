"""Hand-checked values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pagewright.functions import html, http, similarity, stem, text, url
from pagewright.operators import frontier, gates, robots
from pagewright.plans import content, index, pagerank, search


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


URLS = [
    ("http://a.com", "http://a.com:80/", "http://a.com:80", "a.com:80", "/"),
    (" https://a.com/x?q=1#t ", "https://a.com:443/x?q=1#t", "https://a.com:443", "a.com:443", "/x?q=1#t"),
    ("http://a.com:8080/p", "http://a.com:8080/p", "http://a.com:8080", "a.com:8080", "/p"),
    ("http://a.com:xx/p", "http://a.com:80/p", "http://a.com:80", "a.com:80", "/p"),
    ("mailto:x@y.z", None, None, "", None),
    ("http://", None, None, "", None),
    (None, None, None, "", None),
]


def test_url_parts(spark):
    df = spark.createDataFrame([(row[0],) for row in URLS], "url string")
    u = F.col("url")
    normal = url.normalise_url(u)
    rows = df.select(normal, url.crawl_domain(u), url.authority(normal), url.file_path(u)).collect()
    assert [tuple(r) for r in rows] == [row[1:] for row in URLS]


def test_tokens(spark):
    sample = F.lit(", Spark's the café!")
    assert one(spark, text.index_terms(sample)) == ["spark", "caf"]
    assert one(spark, text.query_terms(sample)) == ["spark", "s", "the", "café"]
    assert one(spark, text.legacy_index_terms(sample)) == ["spark", "café"]
    assert one(spark, text.index_terms(F.lit("b" * 50 + " " + "c" * 49))) == ["c" * 49]
    assert one(spark, text.query_terms(F.lit("b" * 50))) == ["b" * 50]
    assert one(spark, text.index_terms(F.lit("\x02graph\x02 a\x02b"))) == ["graph", "a\x02b"]
    assert one(spark, text.index_terms(F.lit(None).cast("string"))) == []


STEMS = {
    "consign": "consign", "consigned": "consign", "consistency": "consist", "consolation": "consol",
    "conspicuous": "conspicu", "knackeries": "knackeri", "knights": "knight", "caresses": "caress",
    "ponies": "poni", "ties": "tie", "gas": "gas", "gaps": "gap", "kiwis": "kiwi", "hopping": "hop",
    "hoping": "hope", "luxuriated": "luxuri", "by": "by", "say": "say", "cry": "cri",
    "relational": "relat", "generously": "generous", "skies": "sky", "dying": "die", "news": "news",
    "proceed": "proceed", "fairly": "fair", "pathology": "patholog", "happiness": "happi",
    "controlling": "control", "abilities": "abil", "university": "univers", "formative": "format",
}


def test_stems(spark):
    assert {w: stem.stem_word(w) for w in STEMS} == STEMS
    words = F.array(*[F.lit(w) for w in STEMS])
    assert one(spark, stem.stem_all(words)) == list(STEMS.values())


def tiny_index(spark):
    docs = spark.createDataFrame(
        [(1, "spark engine spark"), (2, "engine graph"), (3, "graph rank rank rank")], "id long, text string"
    )
    return index.build_index(docs, stem=False, stop_words=None)


def test_index_and_search(spark):
    inverted, idfs = tiny_index(spark)
    assert {r.term: round(r.idf, 6) for r in idfs.collect()} == {
        "spark": 0.405465, "rank": 0.405465, "engine": 0.0, "graph": 0.0,
    }
    weights = {(r.id, r.term): round(r.weight, 6) for r in inverted.collect()}
    assert weights == {
        (1, "spark"): 0.405465, (1, "engine"): 0.0, (2, "engine"): 0.0, (2, "graph"): 0.0,
        (3, "graph"): 0.0, (3, "rank"): 0.405465,
    }
    queries = spark.createDataFrame(
        [(1, "engine"), (2, "spark rank"), (3, "unknown"), (4, ""), (5, "spark spark engine")], "qid long, query string"
    )
    found = search.search_scored(queries, inverted, idfs, stem=False).collect()
    by_query = {}
    for row in found:
        by_query.setdefault(row.qid, []).append((row.id, row.score))
    assert by_query[1] == [(1, None), (2, None)]
    assert [i for i, _ in by_query[2]] == [1, 3]
    assert by_query[2][0][1] == pytest.approx(1 / math.sqrt(2))
    assert 3 not in by_query and 4 not in by_query
    weight = search.query_weights(search.query_counts(queries, stem=False), idfs)
    spark_weight = weight.where("qid = 5 AND term = 'spark'").first().weight
    assert spark_weight == pytest.approx(0.702733, abs=1e-6)


def test_rank_added_to_score_drops_unranked(spark):
    inverted, idfs = tiny_index(spark)
    queries = spark.createDataFrame([(1, "spark rank")], "qid long, query string")
    ranks = spark.createDataFrame([(3, 2.0)], "id long, rank double")
    found = search.search_scored(queries, inverted, idfs, stem=False, ranks=ranks).collect()
    assert [(r.id, round(r.score, 6)) for r in found] == [(3, round(2 + 1 / math.sqrt(2), 6))]


EDGES = [("a", "b"), ("a", "c"), ("b", "c"), ("d", "a")]


def test_pagerank(spark):
    edges = spark.createDataFrame(EDGES, "source string, dest string")
    repaired = pagerank.repair_sinks(edges)
    assert {tuple(r) for r in repaired.collect()} == {*EDGES, ("c", "a"), ("c", "b")}
    first = pagerank.rank_step(repaired, pagerank.out_weights(repaired), pagerank.initial_ranks(repaired))
    assert {r.node: r.rank for r in first.collect()} == pytest.approx({"a": 1.425, "b": 1.0, "c": 1.425})
    second = pagerank.iterate_ranks(repaired, tolerance=None, last_step=1)
    assert {r.node: r.rank for r in second.collect()} == pytest.approx({"a": 0.755625, "b": 1.36125, "c": 1.605625})
    final = pagerank.iterate_ranks(repaired)
    assert {r.node: round(r.rank, 6) for r in final.collect()} == {"a": 0.780814, "b": 1.138658, "c": 1.524234}
    normal = pagerank.pagerank(edges)
    assert {r.domain: round(r.rank, 6) for r in normal.collect()} == {"a": 0.0, "b": 0.481349, "c": 1.0}


def test_equal_ranks_normalise_to_null(spark):
    ring = spark.createDataFrame([("a", "b"), ("b", "a")], "source string, dest string")
    assert [r.rank for r in pagerank.pagerank(ring).collect()] == [None, None]


def bonus_of(spark, title, headers, preview, query, idf=None, strict=False):
    row = spark.createDataFrame(
        [(1, title, headers, preview, 1.0)], "qid long, title string, headers string, preview string, score double"
    )
    details = spark.createDataFrame([(1, query, idf or {})], "qid long, query string, idf_of map<string,double>")
    details = details.withColumn("terms", text.typed_terms(F.col("query")))
    details = details.withColumn("stems", stem.stem_all(F.col("terms")))
    return search.rescore(row, details, strict).first().score


def test_bonus_sequence_only(spark):
    title = "Kevin Durant - Brooklyn Nets - news and analysis, statistics"
    row = spark.createDataFrame([(title, "kevin durant news")], "title string, query string")
    earned = row.select(search.sequence_bonus("title", F.col("title"), F.col("query"))).first()[0]
    assert 1 + earned == pytest.approx(1.1699928, abs=1e-6)


def brute_bonus(title, headers, preview, query, idf, strict=False):
    """The bonus rules, one loop per rule."""
    import re

    terms = [t for t in re.split(r"[!-/:-@\[-`{-~\s]+", query) if t]
    query = query.lower()
    total, size = 0.0, math.log(len(query))
    for name, field, exact, stemmed, sequence, inside in (
        ("title", title, 0.01, 0.003, 0.06, 0.04),
        ("headers", headers, 0.005, 0.0015 if strict else 0.003, 0.03, 0.02),
    ):
        if not field:
            continue
        field = field.lower()
        words = set(re.split(r"[!-/:-@\[-`{-~\s]+", field))
        stems = {stem.stem_word(w) for w in words}
        for term in terms:
            if term.lower() in words:
                total += exact
            elif (name == "headers" and not strict) or stem.stem_word(term) in stems:
                total += stemmed * idf.get(term, 1.0)
        ratio = lcs_table(query, field) / len(query)
        if ratio >= 0.9:
            total += size * sequence * ratio
        if query in field:
            total += size * inside
    if preview and query in preview.lower():
        total += size * 0.04
    return total


def lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


CASES = [
    ("Running Shoes", "Best running shoe", "All about running shoes", "running shoes"),
    ("Runs and runners", "", "", "running running xyz"),
    ("", "Some Header", "nothing", "header graph"),
    ("graph databases", "graphs", "graph databases are", "graph databases"),
    ("t", "h", "p", "a longer query, than the fields"),
    ("Graphs of Graph", "running", "", "Graphing Running RUNS graphs"),
]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("case", CASES)
def test_bonus_against_loops(spark, case, strict):
    idf = {"running": 2.0, "graph": 0.5}
    expected = 1 + brute_bonus(*case, idf, strict)
    assert bonus_of(spark, *case, idf, strict) == pytest.approx(expected, abs=1e-9)


def test_common_subsequence():
    import random

    rng = random.Random(5)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(0, 30))) for _ in "xy")
        assert similarity.lcs_length(a, b) == lcs_table(a, b)


def test_blend(spark):
    score = search.blended_score(F.lit(0.8), F.lit(None).cast("double"))
    assert one(spark, score) == pytest.approx(0.759666, abs=1e-6)


ROBOTS = [
    ("User-agent: *\nDisallow: /private", "/private/x", False),
    ("User-agent: *\nDisallow: /private", "/public", True),
    ("User-agent: *\nDisallow: /a\nAllow: /a/ok", "/a/ok/1", True),
    ("User-agent: *\nDisallow: /*.pdf$", "/d/x.pdf", False),
    ("User-agent: *\nDisallow: /*.pdf$", "/d/x.pdf?y", True),
    ("User-agent: *\nDisallow: /\n\nUser-agent: pagewright\nDisallow: /z", "/y", True),
    ("User-agent: *\nDisallow: /\n\nUser-agent: pagewright\nDisallow: /z", "/z1", False),
    ("User-agent: other\nDisallow: /", "/y", True),
    ("User-agent: *\nDisallow:", "/y", True),
    ("# c\nUser-agent: * # all\r\n#\nDisallow: /q(1)+ # why\r\n", "/q(1)+x", False),
    ("User-agent: *\nUser-agent: pagewright\nDisallow: /b", "/b", False),
    ("", "/y", True),
]


def test_robots(spark):
    sites = [(f"http://s{i}.com:80", rules, False) for i, (rules, _, _) in enumerate(ROBOTS)]
    sites.append(("http://late.com:80", "", True))
    table = spark.createDataFrame(sites, "domain string, robots_txt string, timed_out boolean")
    asked = [(f"http://s{i}.com{path}",) for i, (_, path, _) in enumerate(ROBOTS)] + [("http://late.com/x",), ("http://new.com/x",)]
    urls = spark.createDataFrame(asked, "url string")
    allowed = {r.url for r in robots.robots_filter(urls, robots.robots_records(table)).collect()}
    expected = {u for (u,), (_, _, ok) in zip(asked, ROBOTS) if ok} | {"http://new.com/x"}
    assert allowed == expected
    compat = robots.robots_records(table, compat=True)
    assert "http://s8.com/y" not in {r.url for r in robots.robots_filter(urls, compat).collect()}


def ts(clock):
    return dt.datetime.fromisoformat(f"2024-05-01 {clock}")


def test_politeness(spark):
    urls = spark.createDataFrame(
        [("http://a.com:80/1", "http://a.com:80", 5.0), ("http://a.com:80/2", "http://a.com:80", 5.0),
         ("http://a.com:80/3", "http://a.com:80", 5.0), ("http://b.com:80/1", "http://b.com:80", 0.0),
         ("http://b.com:80/2", "http://b.com:80", 0.0)],
        "url string, domain string, delay double",
    )
    last = spark.createDataFrame([("http://a.com:80", ts("11:59:58"))], "domain string, last_request timestamp_ntz")
    now = F.lit("2024-05-01 12:00:00").cast("timestamp_ntz")
    rows = frontier.due_times(urls, last, now, ["url"]).collect()
    assert {r.url: r.due for r in rows} == {
        "http://a.com:80/1": ts("12:00:03"), "http://a.com:80/2": ts("12:00:08"), "http://a.com:80/3": ts("12:00:13"),
        "http://b.com:80/1": ts("12:00:00"), "http://b.com:80/2": ts("12:00:00"),
    }


def test_http_dates(spark):
    texts = [
        "Sun, 06 Nov 1994 08:49:37 GMT", "Sunday, 06-Nov-94 08:49:37 GMT", "Sun Nov 06 08:49:37 1994", "yesterday", "1994-11-06", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    moment = dt.datetime(1994, 11, 6, 8, 49, 37)
    parsed = df.select(http.parse_http_date(F.col("t")).cast("timestamp_ntz").alias("v")).collect()
    assert [r.v for r in parsed] == [moment] * 3 + [None] * 3
    shown = one(spark, http.format_http_date(F.lit(moment)))
    assert shown == "Sun, 06 Nov 1994 08:49:37 GMT"


def test_content_types(spark):
    accepted = ["text/html; charset=utf-8", "text/xml", "application/xml", "application/rss+xml"]
    df = spark.createDataFrame([(t,) for t in [*accepted, "text/plain", "image/png", None]], "t string")
    assert [r.t for r in df.where(http.is_crawlable_type(F.col("t"))).collect()] == accepted


def test_result_dedupe_and_pages(spark):
    rows = spark.createDataFrame(
        [(1, 1, "T", "P", 0.9), (1, 2, "T", "P", 0.8), (1, 3, "T", "", 0.7), (1, 4, "T", "", 0.6), (1, 5, "", "P", 0.5)],
        "qid long, id long, title string, preview string, score double",
    )
    kept = search.without_repeats(rows, search.by_score())
    assert sorted(r.id for r in kept.collect()) == [1, 3, 4, 5]
    again = search.without_repeats(kept, search.by_score())
    assert again.count() == 4
    ranked = search.final_order(spark.range(23).select(F.lit(1).alias("qid"), "id", (-F.col("id")).cast("double").alias("score")))
    assert search.page_counts(ranked).first().total_pages == 3
    assert sorted(r["rank"] for r in search.result_page(ranked, 3).collect()) == [21, 22, 23]


def test_cards_cut(spark):
    assert one(spark, gates.truncated(F.lit("x" * 71), 70)) == "x" * 70 + " ..."
    assert one(spark, gates.truncated(F.lit("x" * 70), 70)) == "x" * 70


PAGE = """<html><head><title>A &amp; B
 c</title><style>p{}</style></head><body>t1<p>one<p>two <b>bo</b>ld</p>x
<h1>H <i>a</i></h1>mid<h2>b<br>c</h2><script>var a='</p>';</script><!-- <p>no -->
<div>d\xa0e</div><a title="a>b" href='/x?a=1&amp;b=2'>l</a><a name=k>n</a><a href="mailto:x@y">m</a>caf\xe9</body></html>"""


def test_page_fields(spark):
    docs = spark.createDataFrame([(1, PAGE, "text/html"), (2, "<p>x", "text/plain"), (3, "", "text/html")], "id long, content string, type string")
    rows = {r.id: r for r in content.page_content(docs).collect()}
    assert rows.keys() == {1, 3}
    assert rows[1].title == "A & B c"
    assert rows[1].headers == "H a b c"
    assert rows[1].content == "one two bold "
    assert rows[1].body == "t1 one two bold x H a mid b c d e lnmcaf"
    assert (rows[3].title, rows[3].content, rows[3].headers, rows[3].body) == ("", "", "", "")
    texts = {r.id: r.text for r in content.page_texts(docs).collect()}
    assert texts[1].startswith("A & B c t1 one")
    assert (texts[2], texts[3]) == ("x", "")


def test_field_index_counts_title_words_in_the_text_too(spark):
    docs = spark.createDataFrame(
        [(1, "<title>fox</title><h1>caf\xe9</h1><p>fox hen", "text/html"), (2, "plain hen", "text/plain")],
        "id long, content string, type string",
    )
    counts = index.field_counts(content.field_texts(docs), stem=False).collect()
    assert {(r.id, r.term): r.n for r in counts} == {
        (1, "fox"): 12, (1, "caf\xe9"): 5, (1, "hen"): 1, (2, "plain"): 1, (2, "hen"): 1,
    }


def test_robots_pattern_is_quoted(spark):
    patterns = ["/a.b*c$", "/q\\E(1)+", "/x*", "*.gif$", ""]
    paths = ["/a.b/c", "/axb/c", "/q\\E(1)+z", "/x", "/i.gif", "/i.gifs"]
    rows = spark.createDataFrame([(p, q) for p in patterns for q in paths], "pattern string, path string")
    hits = rows.where(F.regexp_like("path", robots.pattern_regex(F.col("pattern")))).collect()
    assert {tuple(r) for r in hits} == {
        ("/a.b*c$", "/a.b/c"), ("/q\\E(1)+", "/q\\E(1)+z"), ("/x*", "/x"), ("*.gif$", "/i.gif"),
        *(("", path) for path in paths),
    }


def test_links(spark):
    pages = spark.createDataFrame([("http://a.com/b/c", PAGE, "text/html"), ("http://z.com/", PAGE, "text/xml")], "url string, document string, type string")
    assert [tuple(r) for r in content.extract_links(pages).collect()] == [("http://a.com/b/c", "http://a.com:80/x?a=1&b=2")]
    based = "<base href='/z/'><a href=q>1</a>"
    assert html.read_links("http://a.com/b", based) == ["http://a.com/z/q"]


def test_preview_stops_after_300(spark):
    paragraphs = F.array(*[F.lit("x" * 149)] * 3)
    assert one(spark, content.preview(paragraphs)) == ("x" * 149 + " ") * 2
