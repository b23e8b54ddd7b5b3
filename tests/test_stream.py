"""Streaming jobs: same rows as the batch jobs, state that survives a second run, repeatable batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pagewright.catalog import QUERIES
from pagewright.operators.robots import robots_records
from pagewright.plans.content import extract_links
from pagewright.schemas import FETCHED_PAGES, URLS
from pagewright.streaming import crawl
from pagewright.streaming.keystore import KeyStore

START = dt.datetime(2024, 1, 1)


def page(n, body, url=None, kind="text/html", status=200, length=None, final=None):
    return (url or f"http://s.com/{n}", body, kind, START + dt.timedelta(minutes=n), status, length, final)


def write(spark, folder, rows):
    spark.createDataFrame(rows, FETCHED_PAGES).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, **options):
    pages = crawl.page_stream(spark, str(tmp_path / "in"))
    crawl.crawl_stream(pages, str(tmp_path / "out"), str(tmp_path / "state"), **options).awaitTermination()
    return crawl.CrawlTables(spark, str(tmp_path / "out"))


def rules(spark, *rows):
    return robots_records(spark.createDataFrame(rows, "domain string, robots_txt string, timed_out boolean"))


def test_crawl_in_two_runs(spark, tmp_path):
    link = "<a href='/{}'>x</a>"
    write(spark, str(tmp_path / "in"), [
        page(1, link.format(1)), page(2, link.format(2)), page(3, link.format(1)), page(4, "png", kind="image/png"),
    ])
    tables = run(spark, tmp_path)
    first = {r.url: r.id for r in tables.urls().collect()}
    assert len(first) == 2 and sorted(first.values()) == [1, 2]

    write(spark, str(tmp_path / "in"), [
        page(5, link.format(2)), page(6, link.format(9)), page(7, "new text\x00" + link.format(8), "http://s.com:80/2"),
    ])
    tables = run(spark, tmp_path)
    second = {r.url: r.id for r in tables.urls().collect()}
    assert {u: i for u, i in second.items() if u in first} == first
    assert set(second) == {*first, "http://s.com:80/6", "http://s.com:80/2"}
    assert sorted(second.values()) == list(range(1, len(second) + 1))
    docs = {r.id: r.content for r in tables.docs().collect()}
    assert docs[second["http://s.com:80/2"]] == "new text" + link.format(8)
    pairs = [tuple(r) for r in tables.links().select("source", "dest").collect()]
    assert len(pairs) == len(set(pairs))
    assert {d for _, d in pairs} >= {"http://s.com:80/9", "http://s.com:80/8"}


def test_repeated_batch_changes_nothing(spark, tmp_path):
    tables = crawl.CrawlTables(spark, str(tmp_path / "out"))
    rows = crawl.accepted_pages(spark.createDataFrame([page(1, "<a href='/q'>x</a>"), page(2, "b")], FETCHED_PAGES))
    state = lambda: [sorted(map(str, f().collect())) for f in (tables.urls, tables.links, tables.docs, tables.url_seen, tables.frontier)]
    tables.write(rows, 0)
    before = state()
    tables.write(rows, 0)
    assert state() == before
    tables.write(rows, 1)
    assert sorted(r.id for r in tables.urls().collect()) == [1, 2]
    assert tables.links().count() == 1


def test_links_are_due_in_the_frontier_over_a_restart(spark, tmp_path):
    records = rules(
        spark, ("http://s.com:80", "User-agent: *\nDisallow: /no\nCrawl-delay: 10", False), ("http://o.com:80", None, None)
    )
    body = "<a href='/a'>x</a><a href='/no/b'>x</a><a href='/c'>x</a><a href='//o.com/d'>x</a><a href='/1'>self</a>"
    write(spark, str(tmp_path / "in"), [page(1, body), page(1, "y", "http://o.com/moved", final="https://new.com/e")])
    tables = run(spark, tmp_path, records=records)
    second = START + dt.timedelta(minutes=1)
    due = {r.url: (r.date_added - second).total_seconds() for r in tables.frontier().collect()}
    assert due == {"http://s.com:80/a": 10, "http://s.com:80/c": 20, "http://o.com:80/d": 0, "https://new.com:443/e": 0}

    # a second run: /a is fetched and leaves the frontier, its link waits behind what is queued
    write(spark, str(tmp_path / "in"), [page(1, "<a href='/f'>x</a><a href='/c'>x</a>", "http://s.com/a")])
    tables = run(spark, tmp_path, records=records)
    due = {r.url: (r.date_added - second).total_seconds() for r in tables.frontier().collect()}
    assert due == {"http://s.com:80/c": 20, "http://s.com:80/f": 30, "http://o.com:80/d": 0, "https://new.com:443/e": 0}


def test_gate_of_stream_and_batch(spark, tmp_path):
    records = rules(spark, ("http://s.com:80", "User-agent: *\nDisallow: /no", False))
    rows = [
        page(1, "a"), page(2, "b", status=404), page(3, "c", length=2_000_001), page(4, "d", kind=None),
        page(5, "e", "http://s.com/no/x"), page(6, "f", final="http://s.com/no/y"), page(7, "g", final="http://t.com/no"),
        page(8, "h", status=None, length=5), page(9, "i", "mailto:x"), page(10, None), page(11, "j", final="nonsense"),
    ]
    write(spark, str(tmp_path / "in"), rows)
    gated = crawl.accepted_pages(crawl.page_stream(spark, str(tmp_path / "in")), records)
    crawl.run_to_parquet(gated.select("url", "route"), str(tmp_path / "o"), str(tmp_path / "s"))
    streamed = sorted(map(tuple, spark.read.parquet(str(tmp_path / "o")).collect()))
    batch = crawl.accepted_pages(spark.createDataFrame(rows, FETCHED_PAGES), records)
    assert streamed == sorted(map(tuple, batch.select("url", "route").collect()))
    routes = {int(u.rsplit("/", 1)[1]): r for u, r in streamed}
    assert routes == {1: "keep", 7: "frontier", 8: "keep", 10: "keep", 11: "keep"}


def test_stream_links_equal_batch(spark, tmp_path):
    rows = [page(i, f"<a href='/{i % 3}'>x</a><a href='//o.com/{i}'>y</a>") for i in range(6)]
    write(spark, str(tmp_path / "in"), rows)
    stream = extract_links(crawl.page_stream(spark, str(tmp_path / "in")))
    crawl.run_to_parquet(stream, str(tmp_path / "links"), str(tmp_path / "links-state"))
    streamed = spark.read.parquet(str(tmp_path / "links"))
    batch = extract_links(spark.read.schema(FETCHED_PAGES).parquet(str(tmp_path / "in")))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


PAGE_ROWS = [(i, f"http://s{i % 2}.com/{i}", f"<a href='/{i % 3}'>x</a>" if i else None) for i in range(7)]


@pytest.mark.parametrize("files", [1, 3])
@pytest.mark.parametrize("rows", [PAGE_ROWS, []])
def test_tables_of_many_files_are_streamed(spark, tmp_path, rows, files):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table.repartition(files).write.parquet(str(tmp_path / "pages.parquet"))
    hashes = QUERIES["R1_stream_source"](spark, str(tmp_path))
    assert hashes.columns == ["url", "hash"]
    assert sorted(map(str, hashes.collect())) == sorted(map(str, table.selectExpr("url", "md5(html) AS hash").collect()))
    links = QUERIES["R4_stream_link_extraction"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in links) == sorted((u, f"http://s{i % 2}.com:80/{i % 3}", 1) for i, u, h in rows if h)


def test_last_seen_over_batches(spark, tmp_path):
    for n in (1, 9, 5):
        write(spark, str(tmp_path / "in"), [page(n, "x", "http://s.com/a")])
    pages = crawl.page_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    seen = crawl.run_latest(crawl.last_seen(pages), str(tmp_path / "seen"), str(tmp_path / "seen-state"), "url")
    assert [r.last_crawled for r in seen.collect()] == [dt.datetime(2024, 1, 1, 0, 9)]
    assert crawl.stored_last_seen(spark, str(tmp_path / "seen-state")).collect() == seen.collect()


def test_second_crawl_skips_and_reuses(spark, tmp_path):
    write(spark, str(tmp_path / "in"), [page(1, "a"), page(2, "b"), page(3, "c")])
    tables = run(spark, tmp_path)
    fetches = spark.createDataFrame(
        [("http://s.com:80/1", "Sun, 31 Dec 2023 00:00:00 GMT"), ("http://s.com:80/2", "Tue, 02 Jan 2024 00:00:00 GMT"),
         ("http://s.com:80/3", None), ("http://s.com:80/4", None)], "url string, last_modified string",
    )

    def plan(start):
        return {r.url[-1]: r.action for r in tables.plan_fetches(fetches, F.lit(start)).collect()}

    assert plan("2024-01-05 00:00:00") == {"1": "reuse", "2": "fetch", "3": "fetch", "4": "fetch"}
    # within the first run all pages were fetched already
    assert plan("2024-01-01 00:00:30") == {"1": "skip", "2": "skip", "3": "skip", "4": "fetch"}


def test_bounded_dedupe_keeps_late_pages_apart(spark, tmp_path):
    day = 24 * 60
    for rows in (
        [page(1, "a"), page(2, "a"), page(3, "b")],
        [page(day, "a", "http://s.com/again"), page(9 * day, "c")],
        [page(9 * day + 1, "a", "http://s.com/later"), page(5, "z", "http://s.com/late")],
    ):
        write(spark, str(tmp_path / "in"), rows)
        tables = run(spark, tmp_path, within="2 days")
    assert sorted(r.url.removeprefix("http://s.com:80") for r in tables.urls().collect()) == ["/1", "/12960", "/3", "/later"]
    assert [r.url for r in tables.late().collect()] == ["http://s.com:80/late"]


def test_hot_content_is_spread(spark, tmp_path):
    """A third of the pages share one content; what meets its pages is keyed by URL."""
    rows = [page(n, "same" if n % 3 == 0 else f"own {n}") for n in range(3000)]
    pages = crawl.accepted_pages(spark.createDataFrame(rows, FETCHED_PAGES)).persist()
    tables = crawl.CrawlTables(spark, str(tmp_path / "out"))
    fresh, _ = tables._first_contents(pages, 0, None)
    assert fresh.count() == 2001
    met = pages.repartition(8, "url", "hash", "fetched_at")
    sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 3000 / 8


# --- key stores


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "s"), URLS, ["url"], buckets=32)
    rows = spark.range(2000).select(F.col("id"), F.concat(F.lit("u"), "id").alias("url"))
    store.write(rows, 0)
    asked = rows.where("id IN (5, 900)").persist()
    found = store.held(asked)
    assert sorted(r.id for r in found.collect()) == [5, 900]
    buckets = {os.path.basename(os.path.dirname(f)) for f in found.inputFiles()}
    assert 1 <= len(buckets) <= 2
    assert len({os.path.basename(os.path.dirname(f)) for f in store.read().inputFiles()}) == 32


@pytest.mark.parametrize("upsert", [False, True])
def test_fifty_batches_cost_no_more_than_five(spark, tmp_path, upsert):
    store = KeyStore(spark, str(tmp_path / "s"), URLS, ["url"], upsert=upsert, buckets=4, merge_after=4)
    files = []
    for batch in range(50):
        key = F.col("id") % 7 if upsert else F.col("id") + 10 * batch
        rows = spark.range(10).select((F.col("id") + 10 * batch).alias("id"), F.concat(F.lit("u"), key).alias("url"))
        store.write(rows.dropDuplicates(["url"]), batch, last_id=10 * batch)
        files.append(len(store.read().inputFiles()))
    # parts of one size class stay below four, classes grow with the logarithm
    assert max(files[40:]) <= 4 * 3 * 4
    assert store.note("last_id", None) == 490 and store.note("last_id", None, before=20) is None
    left = sum(len(names) for _, _, names in os.walk(tmp_path / "s"))
    assert left < 200
    assert store.read().count() == (7 if upsert else 500)


def test_repeated_batch_of_a_store(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "s"), URLS, ["url"], upsert=True, buckets=2, merge_after=2)
    for batch in range(5):
        store.write(spark.createDataFrame([(batch, "a"), (batch, f"b{batch}")], URLS), batch)
    before = sorted(map(tuple, store.read().collect()))
    store.write(spark.createDataFrame([(4, "a"), (4, "b4")], URLS), 4)
    assert sorted(map(tuple, store.read().collect())) == before == [(0, "b0"), (1, "b1"), (2, "b2"), (3, "b3"), (4, "a"), (4, "b4")]
    assert {r.url: r.id for r in store.read(before=4).collect()}["a"] == 3
