"""robots.txt rules as a table, and the filter that applies them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.exprs import bind
from pagewright.functions.url import crawl_domain, file_path
from pagewright.operators.scale import salted_lookup

AGENT = "pagewright"


def _quoted(literal: Column) -> Column:
    """Regex that matches ``literal`` as it stands; an end mark inside is quoted by itself."""
    return F.concat(F.lit(r"\Q"), F.replace(literal, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def pattern_regex(template: Column) -> Column:
    """Robots path pattern as an anchored regex: ``*`` is any text, a final ``$`` an exact end."""
    exact = template.endswith("$")
    stem = F.when(exact, template.substr(F.lit(1), F.length(template) - 1)).otherwise(template)
    body = F.array_join(F.transform(F.split(stem, r"\*", -1), _quoted), ".*")
    return F.concat(F.lit("^"), body, F.when(exact, "$").otherwise(".*$"))


def _value_of(line: Column) -> Column:
    return F.trim(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1))


def _record_lines(lines: Column, agent: str) -> Column:
    """Lines of the record that counts: the agent's own, else the first for ``*``.

    Records end at a blank line. One walk over the lines keeps only where the record starts.
    """
    start = F.struct(
        F.lit("").alias("agent"), F.lit(False).alias("open"), F.lit(None).cast("int").alias("first")
    )

    def walk(state: Column, item: Column) -> Column:
        line, at = item["line"], item["at"]
        name = _value_of(line)
        better = ((state["agent"] == "") & name.isin("*", agent)) | (
            (state["agent"] == "*") & (name == agent)
        )
        taken = ~state["open"] & line.startswith("User-agent:") & better
        return F.struct(
            F.when(taken, name).otherwise(state["agent"]).alias("agent"),
            F.when(line.rlike(r"^\s*$") & ~item["cut"], False)
            .otherwise(state["open"] | taken)
            .alias("open"),
            F.when(taken, at).otherwise(state["first"]).alias("first"),
        )

    numbered = F.transform(
        lines,
        lambda line, at: F.struct(
            F.regexp_extract(line, r"(?s)^([^#]*)", 1).alias("line"),
            line.contains("#").alias("cut"),
            at.alias("at"),
        ),
    )

    def record(rows: Column) -> Column:
        def cut_at_blank(first: Column) -> Column:
            tail = F.slice(rows, first + 1, F.size(rows))
            end = F.get(
                F.filter(tail, lambda r: r["line"].rlike(r"^\s*$") & ~r["cut"]), F.lit(0)
            )["at"]
            return F.slice(rows, first + 1, F.coalesce(end, F.size(rows)) - first)

        first = F.aggregate(rows, start, walk)["first"]
        return bind(first, lambda at: F.when(at.isNotNull(), cut_at_blank(at)))

    return F.transform(bind(numbered, record), lambda r: r["line"])


def robots_records(robots: DataFrame, agent: str = AGENT, compat: bool = False) -> DataFrame:
    """One row per domain: allow and disallow patterns and the crawl delay in seconds.

    ``compat`` keeps empty patterns, which then match every path.
    """

    def values(prefix: str) -> Column:
        found = F.transform(
            F.filter(F.col("_lines"), lambda line: line.startswith(prefix)), _value_of
        )
        return found if compat else F.filter(found, lambda p: p != "")

    timed_out = F.coalesce(F.col("timed_out"), F.lit(False))
    lines = F.split(F.coalesce("robots_txt", F.lit("")), "\n")
    delays = F.filter(values("Crawl-delay:"), lambda d: d.try_cast("double").isNotNull())
    return (
        robots.withColumn(
            "_lines",
            F.coalesce(_record_lines(lines, agent), F.array().cast("array<string>")),
        )
        .select(
            "domain",
            F.when(timed_out, F.array().cast("array<string>"))
            .otherwise(F.array_distinct(values("Allow:")))
            .alias("allow"),
            F.when(timed_out, F.array(F.lit("/")))
            .otherwise(F.array_distinct(values("Disallow:")))
            .alias("disallow"),
            F.when(timed_out, 0.0)
            .otherwise(F.coalesce(F.try_element_at(delays, F.lit(-1)).try_cast("double"), F.lit(0.0)))
            .alias("delay"),
        )
    )


def robots_rules(records: DataFrame) -> DataFrame:
    """Rules in long form: domain, kind, pattern, delay."""

    def tagged(kind: str) -> Column:
        return F.transform(
            F.col(kind), lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern"))
        )

    return records.select(
        "domain", F.explode(F.concat(tagged("allow"), tagged("disallow"))).alias("r"), "delay"
    ).select("domain", "r.kind", "r.pattern", "delay")


def compiled_records(records: DataFrame) -> DataFrame:
    """One regex per kind and domain, so a URL needs no row per rule and no regrouping."""

    def any_of(patterns: Column) -> Column:
        return F.when(
            F.size(patterns) > 0, F.array_join(F.transform(patterns, pattern_regex), "|")
        )

    return records.select(
        "domain",
        any_of(F.col("allow")).alias("_allow"),
        any_of(F.col("disallow")).alias("_disallow"),
        "delay",
    )


def _keyed(urls: DataFrame, url: str) -> DataFrame:
    return urls.withColumn("domain", crawl_domain(F.col(url))).withColumn("_path", file_path(F.col(url)))


def _judged(joined: DataFrame) -> DataFrame:
    """Apply the compiled record that a row was joined with."""

    def matches(pattern: str) -> Column:
        # regexp_instr keeps the compiled pattern while it does not change from row to row
        return F.coalesce(F.regexp_instr(F.col("_path"), F.col(pattern)) > 0, F.lit(False))

    return (
        joined.withColumn("disallowed", matches("_disallow") & ~matches("_allow"))
        .withColumn("delay", F.coalesce("delay", F.lit(0.0)))
        .drop("_allow", "_disallow", "_path")
    )


def with_robots(urls: DataFrame, records: DataFrame, url: str = "url") -> DataFrame:
    """Add ``disallowed`` and the domain's ``delay`` to each URL; a domain may hold most URLs."""
    return _judged(salted_lookup(_keyed(urls, url), compiled_records(records), "domain", "left", [url]))


def stream_with_robots(urls: DataFrame, records: DataFrame, url: str = "url", slices: int = 8) -> DataFrame:
    """``with_robots`` of a stream and a static table of records.

    A stream cannot be counted before it is joined, so every domain's rows are dealt over ``slices``
    copies of its record.
    """
    cut = F.sequence(F.lit(0), F.lit(slices - 1))
    copies = compiled_records(records).withColumn("_slice", F.explode(cut))
    left = _keyed(urls, url).withColumn("_slice", F.pmod(F.xxhash64(url), F.lit(slices)).cast("int"))
    return _judged(left.join(copies, ["domain", "_slice"], "left").drop("_slice"))


def robots_filter(urls: DataFrame, records: DataFrame, url: str = "url") -> DataFrame:
    """URLs the rules allow."""
    return with_robots(urls, records, url).where(~F.col("disallowed")).select(*urls.columns)
