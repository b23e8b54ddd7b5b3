"""Row filters on fetched pages and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.http import fits_size, is_crawlable_type, is_ok_status
from pagewright.functions.url import is_sane_link, normalise_url


def fetch_gate(fetches: DataFrame, max_megabytes: int) -> DataFrame:
    """Accepted type, size within the cap, no error status."""
    return (
        fetches.where(is_crawlable_type(F.col("type")))
        .where(fits_size(F.col("content_length"), max_megabytes))
        .where(is_ok_status(F.col("status")))
    )


def without_self_links(links: DataFrame) -> DataFrame:
    return links.where(F.col("source") != F.col("dest"))


def clean_links(links: DataFrame) -> DataFrame:
    """Normalise link targets and keep the sane ones; anything but http(s) is dropped."""
    normalised = links.withColumn("dest", normalise_url(F.col("dest")))
    return normalised.where(is_sane_link(F.col("dest")))


def truncated(text: Column, limit: int) -> Column:
    return F.when(
        F.length(text) > limit, F.concat(text.substr(1, limit), F.lit(" ..."))
    ).otherwise(text)
