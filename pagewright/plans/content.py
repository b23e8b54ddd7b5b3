"""Page content and link tables from raw pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.html import page_fields, page_links, whole_page
from pagewright.functions.http import contains_html, starts_html
from pagewright.operators.gates import clean_links
from pagewright.operators.scale import spread

PREVIEW_LENGTH = 300


def preview(paragraphs: Column) -> Column:
    """Paragraph texts, each followed by a space, until 300 characters are reached."""
    return F.aggregate(
        paragraphs,
        F.lit(""),
        lambda text, p: F.when(
            F.length(text) < PREVIEW_LENGTH, F.concat(text, p, F.lit(" "))
        ).otherwise(text),
    )


def full_text(fields: Column) -> Column:
    """Title and body text of a page."""
    return F.trim(F.concat_ws(" ", fields["title"], fields["body"]))


def ascii_text(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x01-\x7F]+", "")


def parsed_pages(docs: DataFrame) -> DataFrame:
    """(id, page) with the fields of each document read once; plain text is all body."""
    return spread(docs.select("id", "content")).select("id", page_fields(F.col("content")).alias("page"))


def read_pages(docs: DataFrame) -> DataFrame:
    """(id, url, type, page) of (id, url, content, type) documents, the markup of each read once.

    ``page`` has the fields and, for HTML with a URL, the anchor targets. Store the result: content, texts
    and links of the same documents are then columns of one table.
    """
    rows = spread(docs.select("id", "url", "content", "type"))
    base = F.when(starts_html(F.col("type")), F.col("url"))
    return rows.select("id", "url", "type", whole_page(base, F.col("content")).alias("page"))


def content_of(read: DataFrame) -> DataFrame:
    """The content table of the HTML documents among ``read_pages``."""
    return _content_columns(read.where(contains_html(F.col("type"))))


def texts_of(read: DataFrame) -> DataFrame:
    """(id, text) of all ``read_pages`` for the index."""
    return read.select("id", full_text(F.col("page")).alias("text"))


def links_of(read: DataFrame) -> DataFrame:
    """Normalised, sane links of the HTML pages among ``read_pages``, one row per anchor."""
    html = read.where(starts_html(F.col("type")))
    return clean_links(html.select(F.col("url").alias("source"), F.explode("page.links").alias("dest")))


def _content_columns(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "id",
        F.col("page.title").alias("title"),
        preview(F.col("page.paragraphs")).alias("content"),
        F.col("page.headers").alias("headers"),
        ascii_text(F.col("page.body")).alias("body"),
    )


def page_content(docs: DataFrame) -> DataFrame:
    """The content table of the HTML documents: id, title, content (preview), headers, body."""
    return _content_columns(parsed_pages(docs.where(contains_html(F.col("type")))))


def page_texts(docs: DataFrame) -> DataFrame:
    """(id, text) for the index: title and body text of every document, markup removed."""
    return parsed_pages(docs).select("id", full_text(F.col("page")).alias("text"))


def field_texts(docs: DataFrame) -> DataFrame:
    """(id, text, headers, title) of every document; the text holds headers and title too."""
    return parsed_pages(docs).select(
        "id", full_text(F.col("page")).alias("text"), "page.headers", "page.title"
    )


def raw_links(pages: DataFrame) -> DataFrame:
    """(source, dest) for every anchor of an HTML page; targets absolute but not normalised."""
    html = spread(pages.where(starts_html(F.col("type"))).select("url", "document"))
    return html.select(
        F.col("url").alias("source"),
        F.explode(page_links(F.col("url"), F.col("document"))).alias("dest"),
    )


def extract_links(pages: DataFrame) -> DataFrame:
    """Normalised, sane links of HTML pages, one row per anchor."""
    return clean_links(raw_links(pages))
