"""Crawl planning over tables: due times, frontier updates, batches, recrawl and redirect decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.http import parse_http_date
from pagewright.functions.url import crawl_domain, normalise_url
from pagewright.operators.robots import stream_with_robots, with_robots
from pagewright.operators.scale import positions, salted_lookup
from pagewright.operators.tables import absent
from pagewright.session import stage


def _plus_millis(ts: Column, millis: Column) -> Column:
    return ts + F.make_dt_interval(secs=millis / 1000)


def crawl_delay(urls: DataFrame, records: DataFrame) -> DataFrame:
    """Delay in seconds for the domain of each URL, 0 when the domain has no rules."""
    return with_robots(urls, records).select(*urls.columns, "delay")


def due_times(urls: DataFrame, last_requests: DataFrame, now: Column, order: list[str]) -> DataFrame:
    """``due`` per URL: not before the domain's delay has passed, one more delay per earlier URL.

    ``urls`` carries ``domain`` and ``delay``; ``last_requests`` holds (domain, last_request).
    """
    numbered = positions(urls, order, group="domain")
    joined = salted_lookup(numbered, last_requests, "domain", "left", order)
    delay = F.round(F.col("delay") * 1000)
    first = F.greatest(now, F.coalesce(_plus_millis(F.col("last_request"), delay), now))
    return joined.withColumn(
        "due", _plus_millis(first, (F.col("position") - 1) * delay)
    ).select(*urls.columns, "due")


def frontier_additions(
    known: DataFrame, discovered: DataFrame, records: DataFrame, last_requests: DataFrame, now: Column
) -> DataFrame:
    """(url, domain, due) of the discovered URLs that are allowed and not among the ``known`` ones."""
    urls = discovered.select(normalise_url(F.col("url")).alias("url")).where("url IS NOT NULL")
    # counted for hot domains before it is joined, so it is worked out once
    fresh = stage(absent(urls, known, ["url"]), "fresh")
    allowed = with_robots(fresh, records).where(~F.col("disallowed"))
    added = due_times(allowed.select("url", "domain", "delay"), last_requests, now, ["url"])
    return added.select("url", "domain", "due")


def frontier_update(
    frontier: DataFrame,
    discovered: DataFrame,
    records: DataFrame,
    last_requests: DataFrame,
    now: Column,
) -> DataFrame:
    """Frontier plus the discovered URLs that are allowed and not queued yet, with their due time."""
    added = frontier_additions(frontier, discovered, records, last_requests, now)
    return frontier.select("url", "date_added").unionByName(
        added.select("url", F.col("due").alias("date_added"))
    )


def oldest_first(frontier: DataFrame, n: int) -> DataFrame:
    return frontier.orderBy("date_added", "url").limit(n)


def next_batch(frontier: DataFrame, now: Column, n: int) -> DataFrame:
    """The ``n`` oldest URLs that are due."""
    return oldest_first(frontier.where(F.col("date_added") <= now), n)


def domain_cap(arrivals: DataFrame, cap: int) -> DataFrame:
    """Arrivals up to and including the one that makes ``cap`` distinct domains known.

    ``arrivals`` has (url, arrived_at); later rows are refused whatever their domain.
    """
    keyed = arrivals.withColumn("_domain", crawl_domain(F.col("url")))
    firsts = keyed.groupBy("_domain").agg(F.min(F.struct("arrived_at", "url")).alias("_first"))
    ordered = positions(
        firsts.select("_first.arrived_at", "_first.url"), ["arrived_at", "url"]
    )
    # one row at most, none when fewer domains than the cap are known
    last = ordered.where(F.col("position") == cap).select(F.struct("arrived_at", "url"))
    limit = last.scalar()
    return arrivals.where(limit.isNull() | (F.struct("arrived_at", "url") <= limit))


def recrawl_plan(
    fetches: DataFrame, seen: DataFrame, stored: DataFrame, used: DataFrame, run_start: Column
) -> DataFrame:
    """Add ``action``: skip, reuse (the stored copy) or fetch.

    ``fetches`` (url, last_modified text), ``seen`` (url, last_crawled), ``stored`` (url, hash) and
    ``used`` (hash), the contents this run already has. Of equal stored copies the first URL is reused.
    """
    joined = (
        fetches.join(seen.select("url", "last_crawled"), "url", "left")
        .join(stored.select("url", "hash"), "url", "left")
        .withColumn("_modified", parse_http_date(F.col("last_modified")))
    )
    unchanged = F.coalesce(F.col("_modified") < F.col("last_crawled"), F.lit(False))
    state = (
        F.when(F.coalesce(run_start < F.col("last_crawled"), F.lit(False)), "skip")
        .when(unchanged & F.col("hash").isNull(), "skip")
        .when(unchanged, "reuse")
        .otherwise("fetch")
    )
    decided = joined.withColumn("_state", state)
    reusable = (
        decided.where(F.col("_state") == "reuse")
        .join(used.select("hash"), "hash", "left_anti")
        .groupBy("hash")
        .agg(F.min("url").alias("url"))
        .select("url", F.lit(True).alias("_reuse"))
    )
    action = F.when((F.col("_state") == "reuse") & F.col("_reuse").isNull(), "skip").otherwise(
        F.col("_state")
    )
    return decided.join(reusable, "url", "left").select(
        *fetches.columns, "last_crawled", action.alias("action")
    )


def seen_after(plan: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """The url-seen table once the planned fetches are stamped."""
    stamped = plan.where("action = 'fetch'").select("url", now.alias("last_crawled")).distinct()
    return seen.join(stamped, "url", "left_anti").select("url", "last_crawled").unionByName(stamped)


def redirect_routes(fetches: DataFrame, records: DataFrame) -> DataFrame:
    """Add ``route``: frontier when the final URL has another domain, drop when disallowed, else keep."""
    check = stream_with_robots if fetches.isStreaming else with_robots
    checked = check(fetches, records, "final_url")
    same = F.coalesce(crawl_domain(F.col("url")) == F.col("domain"), F.lit(False))
    route = F.when(~same, "frontier").when(F.col("disallowed"), "drop").otherwise("keep")
    return checked.select(
        *fetches.columns, normalise_url(F.col("final_url")).alias("target"), route.alias("route")
    )


def crawl_progress(polls: DataFrame, target: int) -> DataFrame:
    """Add ``stop``: the corpus reached the target, or did not grow since the poll before.

    One row per poll (minutes to hours apart), so ordering them in one place is bounded by time.
    """
    before = F.lag("docs").over(Window.orderBy("polled_at"))
    return polls.withColumn(
        "stop", (F.col("docs") >= target) | F.coalesce(F.col("docs") == before, F.lit(False))
    )
