"""The crawl as one Structured Streaming query over arriving page files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pagewright.functions.http import content_hash, strip_nul
from pagewright.functions.url import crawl_domain, normalise_url
from pagewright.operators.frontier import frontier_additions, recrawl_plan, redirect_routes
from pagewright.operators.gates import fetch_gate
from pagewright.operators.robots import robots_records
from pagewright.operators.tables import absent, latest_by_key, new_urls
from pagewright.plans.content import extract_links
from pagewright.schemas import (
    CONTENT_SEEN,
    CRAWLER_DOCS,
    DOMAIN_REQUESTS,
    FETCHED_PAGES,
    FRONTIER,
    LINKS_URL,
    PAGE_SEEN,
    URLS,
)
from pagewright.session import stage, staging, together
from pagewright.streaming.keystore import KeyStore

MAX_MEGABYTES = 2
LATE_COLUMNS = ["url", "document", "type", "fetched_at"]


def page_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType = FETCHED_PAGES,
    files: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Rows of the parquet files that arrive in ``folder``."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def accepted_pages(
    pages: DataFrame, records: DataFrame | None = None, max_megabytes: int = MAX_MEGABYTES
) -> DataFrame:
    """The crawl's gate, for a stream as for a table: crawlable type, size within the cap, no error status,
    normalised URL, NUL-free text, final URL allowed by ``records``.

    Adds ``hash`` of the content, ``target``, the normalised final URL, and ``route``: keep, or frontier
    for a page that was answered by another domain, whose target is to be fetched on its own.
    """
    unknown = {"status": "int", "content_length": "long", "final_url": "string"}
    for name, kind in unknown.items():
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast(kind))
    if records is None:
        records = robots_records(pages.sparkSession.createDataFrame([], "domain string, robots_txt string, timed_out boolean"))
    gated = (
        fetch_gate(pages.withColumn("status", F.coalesce("status", F.lit(200))), max_megabytes)
        .withColumn("url", normalise_url(F.col("url")))
        .where("url IS NOT NULL")
        .withColumn("final_url", F.coalesce(normalise_url(F.col("final_url")), "url"))
        .withColumn("hash", content_hash(F.col("document")))
        .withColumn("document", strip_nul(F.col("document")))
    )
    return redirect_routes(gated, records).where("route <> 'drop'")


def last_seen(pages: DataFrame) -> DataFrame:
    """Latest fetch time per URL; run it in update mode."""
    return pages.groupBy("url").agg(F.max("fetched_at").alias("last_crawled"))


def apply_step(stream: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user-defined step is any function from DataFrame to DataFrame."""
    return stream.transform(step)


def stored_last_seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The running (url, last_crawled) of a ``last_seen`` query, read from the state in its checkpoint."""
    state = spark.read.format("statestore").load(checkpoint)
    [total] = state.schema["value"].dataType.names
    return state.select("key.url", F.col("value")[total].alias("last_crawled"))


def _raised(store: KeyStore, rows: DataFrame, by: str, before: int) -> DataFrame:
    """``rows`` and what ``store`` holds of their keys, of each key the one with the largest ``by``."""
    [key] = store.keys
    rest = [name for name in rows.columns if name not in (key, by)]
    both = store.held(rows, before).unionByName(rows)
    return both.groupBy(key).agg(F.max(F.struct(by, *rest)).alias("_last")).select(key, "_last.*")


class CrawlTables:
    """The tables a crawl keeps, each a ``KeyStore``: a micro-batch reads only the buckets of its keys.

    urls, crawler_docs and links_url are the crawl's results; url_seen, contents and domains are what it
    remembers of pages, contents and requests; frontier holds what is to be fetched, and when. A
    micro-batch that is repeated after a failure reads what was there before it and replaces its own
    rows, so every table holds each batch exactly once.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16, merge_after: int = 8):
        self.spark, self.folder = spark, folder
        self._sizes = buckets, merge_after

        def store(name: str, schema: StructType, keys: list[str], upsert: bool = False) -> KeyStore:
            return KeyStore(spark, f"{folder}/{name}", schema, keys, upsert, buckets, merge_after)

        self.url_ids = store("urls", URLS, ["url"])
        self.documents = store("crawler_docs", CRAWLER_DOCS, ["id"], upsert=True)
        self.link_pairs = store("links_url", LINKS_URL, ["source", "dest"])
        self.contents = store("contents", CONTENT_SEEN, ["hash"], upsert=True)
        self.seen = store("url_seen", PAGE_SEEN, ["url"], upsert=True)
        self.queued = store("frontier", FRONTIER, ["url"])
        self.domains = store("domains", DOMAIN_REQUESTS, ["domain"], upsert=True)

    def urls(self) -> DataFrame:
        return self.url_ids.read()

    def links(self) -> DataFrame:
        return self.link_pairs.read()

    def docs(self) -> DataFrame:
        """The latest version of every document."""
        return self.documents.read()

    def url_seen(self) -> DataFrame:
        return self.seen.read().select("url", "last_crawled")

    def frontier(self) -> DataFrame:
        """Queued URLs that were not fetched yet, with the time they are due."""
        return self.queued.read().join(self.seen.read().select("url"), "url", "left_anti")

    def late(self) -> DataFrame:
        """Pages that came after the time their contents are remembered for; they were not stored."""
        schema = StructType([f for f in FETCHED_PAGES.fields if f.name in LATE_COLUMNS])
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/late")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/late/*")

    def plan_fetches(self, fetches: DataFrame, run_start: Column) -> DataFrame:
        """``recrawl_plan`` of ``fetches(url, last_modified)`` against what earlier runs saw and stored.

        A content counts as used once this run, from ``run_start`` on, has met it.
        """
        asked = fetches.select("url").distinct().persist()
        seen = self.seen.held(asked)
        hashes = seen.select("hash").distinct().persist()
        used = self.contents.held(hashes).where(F.col("fetched_at") >= run_start)
        return recrawl_plan(fetches, seen, seen, used, run_start)

    def _first_contents(self, pages: DataFrame, batch: int, within: str | None) -> tuple[DataFrame, DataFrame]:
        """The pages whose content is new, and the hashes met with the time they were met first and last.

        Firsts are found on (hash, time, url) rows, combined before the shuffle; of a content that a
        third of the pages share one page goes on, and pages only meet their own URL.
        """
        met = (
            pages.groupBy("hash")
            .agg(F.min(F.struct("fetched_at", "url")).alias("first"), F.max("fetched_at").alias("fetched_at"))
            .persist()
        )
        known = self.contents.held(met, batch)
        if within is not None:
            until = known.withColumnRenamed("fetched_at", "_met").join(met, "hash")
            known = until.where(F.col("_met") + F.expr(f"INTERVAL {within}") >= F.col("first.fetched_at"))
        fresh = met.join(known.select("hash"), "hash", "left_anti").select("hash", "first.*")
        keys = ["url", "hash", "fetched_at"]
        return pages.join(fresh, keys, "left_semi").dropDuplicates(keys), met

    def write(
        self, pages: DataFrame, batch: int, records: DataFrame | None = None, within: str | None = None
    ) -> None:
        """Store one micro-batch of ``accepted_pages``."""
        # a micro-batch has a session of its own
        spark = pages.sparkSession
        with staging(spark):
            CrawlTables(spark, self.folder, *self._sizes)._write(pages, batch, records, within)

    def _write(self, pages: DataFrame, batch: int, records: DataFrame | None, within: str | None) -> None:
        pages = pages.persist()
        kept = pages.where("route = 'keep'")
        newest = self.contents.note("newest", None, before=batch)
        if within is not None and newest is not None:
            limit = F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {within}")
            kept.where(F.col("fetched_at") < limit).select(*LATE_COLUMNS).write.mode("overwrite").parquet(
                f"{self.folder}/late/batch={batch:09d}"
            )
            kept = kept.where(F.col("fetched_at") >= limit)
        fresh, met = self._first_contents(kept, batch, within)
        fresh = fresh.persist()
        latest = latest_by_key(fresh.select("url", "document", "type", "fetched_at"), "url", "fetched_at").persist()
        pair = ["source", "dest"]
        links = extract_links(fresh).select(*pair).distinct().persist()
        fetched = kept.groupBy("url").agg(F.max(F.struct("fetched_at", "hash")).alias("last"))
        fetched = fetched.select("url", F.col("last.fetched_at").alias("last_crawled"), "last.hash").persist()
        try:
            last_id = self.url_ids.note("last_id", 0, before=batch)
            known = self.url_ids.held(latest, batch)
            added = self.url_ids.write(
                new_urls(known, latest, F.lit(last_id).cast("long")), batch, last_id=last_id + self._unknown(known, latest)
            )
            ids = known.unionByName(added)
            last = pages.agg(F.unix_micros(F.max("fetched_at"))).first()[0]
            seen = [time for time in (newest, last) if time is not None]
            contents = latest.join(ids, "url").select("id", F.col("document").alias("content"), "type")
            newly_met = met.select("hash", "fetched_at")
            together(
                lambda: self.documents.write(contents, batch),
                lambda: self.link_pairs.write(absent(links, self.link_pairs.held(links, batch), pair), batch),
                lambda: self.contents.write(
                    _raised(self.contents, newly_met, "fetched_at", batch), batch, newest=max(seen, default=None)
                ),
                lambda: self.seen.write(_raised(self.seen, fetched, "last_crawled", batch), batch),
                lambda: last is not None
                and self._queue(links, pages, fetched, records, F.timestamp_micros(F.lit(last)), batch),
            )
        finally:
            for part in (fetched, links, latest, fresh, met, pages):
                part.unpersist()

    @staticmethod
    def _unknown(known: DataFrame, latest: DataFrame) -> int:
        return latest.count() - known.count()

    def _queue(
        self, links: DataFrame, pages: DataFrame, fetched: DataFrame, records: DataFrame | None, now: Column, batch: int
    ) -> None:
        """Queue what the batch found: links of new pages and targets of redirects to other domains.

        A domain's first URL is due one delay after its last request, made or queued, each further one
        a delay later; so the spacing holds over batches and restarts.
        """
        if records is None:
            records = robots_records(self.spark.createDataFrame([], "domain string, robots_txt string, timed_out boolean"))
        found = links.select(F.col("dest").alias("url")).unionByName(
            pages.where("route = 'frontier'").select(F.col("target").alias("url"))
        )
        found = found.where("url IS NOT NULL").distinct().persist()
        known = self.queued.held(found, batch).select("url")
        known = known.unionByName(self.seen.held(found, batch).select("url")).unionByName(fetched.select("url"))
        domain = crawl_domain(F.col("url")).alias("domain")
        requests = fetched.groupBy(domain).agg(F.max("last_crawled").alias("last_request"))
        asked = found.select(domain).unionByName(fetched.select(domain)).distinct()
        asked = asked.join(requests, "domain", "left").persist()
        requests = _raised(self.domains, asked, "last_request", batch).persist()
        added = stage(frontier_additions(known, found, records, requests, now), "queued")
        self.queued.write(added.select("url", F.col("due").alias("date_added")), batch)
        due = added.groupBy("domain").agg(F.max("due").alias("due"))
        self.domains.write(
            requests.join(due, "domain", "left")
            .select("domain", F.greatest("last_request", "due").alias("last_request"))
            .where("last_request IS NOT NULL"),
            batch,
        )
        for part in (found, asked, requests):
            part.unpersist()


def crawl_stream(
    pages: DataFrame,
    folder: str,
    checkpoint: str,
    within: str | None = None,
    records: DataFrame | None = None,
) -> StreamingQuery:
    """Gate, dedupe, store and queue everything available, then stop; the checkpoint resumes it.

    Contents are remembered for the whole crawl unless ``within`` (such as "7 days") lets them go once
    event time has moved on by that much; pages older than that are kept apart. ``records`` are the
    robots records of the domains.
    """
    tables = CrawlTables(pages.sparkSession, folder)
    return (
        accepted_pages(pages, records)
        .writeStream.foreachBatch(lambda rows, batch: tables.write(rows, batch, records, within))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_parquet(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Append everything available to a parquet folder."""
    (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_latest(stream: DataFrame, folder: str, checkpoint: str, key: str) -> DataFrame:
    """Run an updating aggregate and return its newest row per key.

    Each batch's changed rows go to their own folder; the highest batch wins.
    """

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch:09d}")

    (
        stream.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    written = stream.sparkSession.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    return latest_by_key(written, key, "batch").drop("batch")
