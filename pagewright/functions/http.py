"""HTTP response metadata: type, size and status rules, dates, content hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTES_PER_MEGABYTE = 1_000_000


def contains_html(content_type: Column) -> Column:
    return F.coalesce(content_type.contains("text/html"), F.lit(False))


def starts_html(content_type: Column) -> Column:
    return F.coalesce(content_type.startswith("text/html"), F.lit(False))


def is_crawlable_type(content_type: Column) -> Column:
    accepted = (
        content_type.startswith("text/html")
        | content_type.startswith("text/xml")
        | content_type.startswith("application/xml")
        | content_type.contains("+xml")
    )
    return F.coalesce(accepted, F.lit(False))


def fits_size(content_length: Column, max_megabytes: int) -> Column:
    """A missing length passes."""
    return F.coalesce(content_length <= BYTES_PER_MEGABYTE * max_megabytes, F.lit(True))


def is_ok_status(status: Column) -> Column:
    return status < 400


def strip_nul(text: Column) -> Column:
    return F.translate(text, "\u0000", "")


def content_hash(text: Column) -> Column:
    return F.md5(text)


def parse_http_date(text: Column, now: Column | None = None) -> Column:
    """RFC 1123, RFC 850 and asctime dates as timestamps (session time zone UTC); else NULL.

    The two-digit years of RFC 850 fall in the 100 years that end 20 years from ``now``.
    """
    now = F.current_timestamp() if now is None else now
    weekday = "(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)"
    full_weekday = "(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)"
    trimmed = F.trim(text)

    def parsed(pattern: str, layout: str) -> Column:
        return F.try_to_timestamp(
            F.nullif(F.regexp_extract(trimmed, pattern, 1), F.lit("")), F.lit(layout)
        )

    rfc_1123 = parsed(rf"^{weekday}, (.+) (?:GMT|UTC)$", "d MMM yyyy HH:mm:ss")
    rfc_850 = parsed(rf"^{full_weekday}, (.+) (?:GMT|UTC)$", "d-MMM-yy HH:mm:ss")
    rfc_850 = F.when(
        rfc_850 > F.add_months(now, 20 * 12), rfc_850 - F.make_ym_interval(F.lit(100))
    ).otherwise(rfc_850)
    asctime = parsed(rf"^{weekday} (.+)$", "MMM d HH:mm:ss yyyy")
    return F.coalesce(rfc_1123, rfc_850, asctime)


def format_http_date(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
