"""URL parts and normalisation with native expressions; anything that is not http(s) gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Pieces of an absolute URL, ports per scheme, longest link kept.
PIECES = r"^(https?)://([^/]+)(/.*)?$"
DEFAULT_PORTS = {"https": "443", "http": "80"}
MAX_LINK_LENGTH = 2048
MAX_PORT = 2147483647


def _piece(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(url), "(?s)" + PIECES, group)


def _is_web(url: Column) -> Column:
    return F.trim(url).rlike("(?s)" + PIECES)


def _host_port(url: Column) -> Column:
    address = _piece(url, 2)
    host = F.trim(F.substring_index(address, ":", 1))
    written = F.trim(F.regexp_extract(address, "^[^:]*:(.*)$", 1))
    port = F.when(written.rlike(r"^[+-]?\d{1,10}$"), written.cast("long"))
    default = F.when(_piece(url, 1) == "https", DEFAULT_PORTS["https"]).otherwise(
        DEFAULT_PORTS["http"]
    )
    usable = F.when(F.abs(port) <= MAX_PORT, port.cast("string"))
    return F.concat(host, F.lit(":"), F.coalesce(usable, default))


def crawl_domain(url: Column) -> Column:
    """``scheme://host:port`` with the port always written out."""
    return F.when(_is_web(url), F.concat(_piece(url, 1), F.lit("://"), _host_port(url)))


def file_path(url: Column) -> Column:
    """Path with query and fragment; ``/`` when there is none."""
    path = _piece(url, 3)
    return F.when(_is_web(url), F.when(path == "", "/").otherwise(path))


def normalise_url(url: Column) -> Column:
    return F.concat(crawl_domain(url), file_path(url))


def authority(url: Column) -> Column:
    """``host:port`` exactly as written in the URL, '' when there is none."""
    return F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))


def is_sane_link(url: Column) -> Column:
    return (F.length(url) > 0) & (F.length(url) <= MAX_LINK_LENGTH)


def domain_shard(domain: Column, shards: int) -> Column:
    """Number of the shard that owns a domain, from its MD5; any other engine can work it out too."""
    leading = F.conv(F.substring(F.md5(domain), 1, 8), 16, 10).cast("long")
    return F.pmod(leading, F.lit(shards)).cast("int")


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``GET_DOMAIN(url)`` callable from SQL text; the body is a native SQL expression."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION GET_DOMAIN(url STRING) RETURNS STRING "
        "RETURN coalesce(try_parse_url(url, 'AUTHORITY'), '')"
    )
