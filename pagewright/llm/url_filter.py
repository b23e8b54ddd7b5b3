"""URL verdicts: host and path rules, then a list of URLs behind a blocked Bloom filter.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.columns import ascii_lower, whole

BITS_PER_URL = 16
BITS_SET = 5
# 2**17 words of 64 bits: the filter a task holds never exceeds 1 MiB, however long the list
MAX_WORDS = 1 << 17

AFTER_SCHEME = r"(?s)^.*?://"
# parameters that only track the visit
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(whole(url), r"^(?s:.*?)://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(whole(url), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One form for the addresses of a page: no scheme, ``www.``, fragment, tracking or final slash.

    A null URL and one without ``://`` have none (null).
    """
    url = whole(url)
    query = F.split(F.regexp_extract(url, r"^(?s:.*?)://[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    bare_host = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    form = F.concat(
        bare_host,
        F.regexp_replace(path(url), r"/+$", ""),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""),
    )
    return F.when(F.contains(url, F.lit("://")), form)


def matching_rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """The longest of ``(verdict, host, path prefix)`` rules that fits, as a struct (rule, verdict), or null.

    A rule fits its host and the host's subdomains when the path starts with the rule's. Rules of
    one length are tried in the order given.
    """
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    cases = [
        F.when(
            ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start)),
            F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, name, start in longest_first
    ]
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*cases, nothing)


def _word(key: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(key), size)


def _mask(key: Column) -> Column:
    """``BITS_SET`` bits of one 64-bit word, taken from a second hash six bits at a time."""
    bits = F.xxhash64(F.lit("bits"), key)
    ones = [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(bits, 6 * i), F.lit(64)).cast("int"))
        for i in range(BITS_SET)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), ones)


def blocked_bloom(listed: DataFrame, key: str) -> DataFrame:
    """A blocked Bloom filter of ``key``: one row with ``words``, an array of 64-bit blocks.

    ``BITS_PER_URL`` bits per listed value up to ``MAX_WORDS`` blocks; a longer list fills the
    blocks further, which passes more values to the exact join but never changes a result.
    """
    keys = listed.select(key).where(F.col(key).isNotNull())
    size = keys.agg(
        F.least(
            F.lit(MAX_WORDS),
            F.greatest(F.lit(1), F.ceil(F.approx_count_distinct(key) * BITS_PER_URL / 64)),
        ).cast("long").alias("size")
    )
    blocks = (
        keys.crossJoin(F.broadcast(size))  # one row, so no product
        .groupBy("size", _word(F.col(key), F.col("size")).alias("block"))
        .agg(F.bit_or(_mask(F.col(key))).alias("word"))
    )
    every = F.broadcast(size).select("size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("block"))
    return (
        every.join(blocks.drop("size"), "block", "left")
        .agg(F.array_sort(F.collect_list(F.struct("block", F.coalesce("word", F.lit(0).cast("long")).alias("word")))).alias("all"))
        .select(F.col("all.word").alias("words"))
    )


def maybe_listed(key: Column, words: Column) -> Column:
    """True for every listed value and for few others; null keys are never listed."""
    block = F.element_at(words, (_word(key, F.size(words)) + 1).cast("int"))
    mask = _mask(key)
    return F.coalesce(block.bitwiseAND(mask) == mask, F.lit(False))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages(page_id, url)`` with host, path, rule, verdict and whether the URL is on the list.

    Rows that a rule decides keep the rule's verdict. For the others, the Bloom filter of the
    canonical ``listed(url)`` passes possible hits to an exact join on the canonical URL, and a
    true hit is ``block``; everything else is ``allow``. Only possible hits are shuffled, and a hot
    URL is split by the skew handling of the join, since the list holds each URL once.

    Null URLs, and URLs without ``://``, have an empty host and path, fit no rule and are on no
    list: ``allow``. Repeated rows each get their verdict. An empty list allows what no rule blocks.
    Further columns of either table are ignored.
    """
    listed = listed.select(canonical(F.col("url")).alias("listed_url")).where(F.col("listed_url").isNotNull()).distinct()
    bloom = blocked_bloom(listed, "listed_url").scalar()
    judged = (
        pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
        .withColumn("match", matching_rule(rules, F.col("host"), F.col("path")))
        .withColumn("canonical_url", canonical(F.col("url")))
        .withColumn("possible", F.col("match").isNull() & maybe_listed(F.col("canonical_url"), bloom))
    )
    shared = ["page_id", "url", "host", "path", F.col("match.rule").alias("rule")]
    clear = judged.where(~F.col("possible")).select(
        *shared,
        F.coalesce("match.verdict", F.lit("allow")).alias("verdict"),
        F.lit(False).alias("on_list"),
    )
    hit = F.col("listed_url").isNotNull()
    checked = judged.where("possible").join(listed, F.col("canonical_url") == F.col("listed_url"), "left").select(
        *shared, F.when(hit, "block").otherwise("allow").alias("verdict"), hit.alias("on_list")
    )
    return clear.unionByName(checked)
