"""One-pass HTML field extraction, the only page work Spark has no expression for."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from pagewright.functions.exprs import once

# Elements that separate words, and those that end an open paragraph.
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote body center details dialog dir div dl dd dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
SEPARATES_WORDS = CLOSES_PARAGRAPH | frozenset("br title head caption option noscript".split())

# comments, raw-text elements, tags, declarations; everything between two matches is text
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
UNFINISHED = re.compile(r"<(?:/?[a-z]|[!?/])", re.IGNORECASE)
BARE_TAG = re.compile(
    r"<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>[^<>]*)>", re.IGNORECASE
)
HREF = re.compile(r"""(?:^|[\s"'])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
SPACE = re.compile(r"[ \t\n\f\r\xa0]+")
# what a text without markup must not hold to be read natively: marks, references, other white space
NOT_PLAIN = r"[<&\x0b\x1c-\x1f\x85\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

PAGE_FIELDS = StructType(
    [
        StructField("title", StringType()),
        StructField("headers", StringType()),
        StructField("paragraphs", ArrayType(StringType())),
        StructField("body", StringType()),
    ]
)
WHOLE_PAGE = StructType([*PAGE_FIELDS.fields, StructField("links", ArrayType(StringType()))])


def _markup(html: str) -> Iterator[re.Match]:
    """Matches of ``MARKUP`` in one forward pass: a mark that nothing ends makes the rest text."""
    at = html.find("<")
    while at >= 0:
        found = MARKUP.match(html, at)
        if found is None and UNFINISHED.match(html, at):
            if html.find(">", at) < 0:
                return
            # an open quote: read this page's further tags without regard to quotes
            yield from BARE_TAG.finditer(html, at)
            return
        if found is not None:
            yield found
        at = html.find("<", found.end() if found else at + 1)


def _squeeze(pieces: list[str]) -> str:
    return SPACE.sub(" ", "".join(pieces)).strip()


def read_fields(
    html: str, visit: Callable[[re.Match], None] | None = None
) -> tuple[str, str, list[str], str]:
    """Title, h1/h2 text, paragraph texts and body text of one page; ``visit`` is shown each mark."""
    title, body, headers, paragraphs = [], [], [], []
    titles, in_title, in_header, in_paragraph = 0, False, None, False
    position = 0

    def write(text: str) -> None:
        if in_title:
            if titles == 1:
                title.append(text)
            return
        body.append(text)
        if in_header:
            headers[-1].append(text)
        if in_paragraph:
            paragraphs[-1].append(text)

    for found in _markup(html):
        if visit is not None:
            visit(found)
        if found.start() > position:
            write(unescape(html[position : found.start()]))
        position = found.end()
        name = (found["name"] or "").lower()
        opening = not found["end"]
        if in_title and name != "title":
            write(unescape(found.group()))  # a title holds text only
            continue
        if not name:
            continue
        if name in CLOSES_PARAGRAPH and (opening or name != "p"):
            in_paragraph = False
        if name in SEPARATES_WORDS:
            write(" ")
        if name == "title":
            in_title, titles = opening, titles + opening
        elif name in ("h1", "h2"):
            in_header = name if opening else None
            if opening:
                headers.append([])
        elif name == "p":
            if opening or not in_paragraph:
                paragraphs.append([])
            in_paragraph = opening
    write(unescape(html[position:]))
    header_text = " ".join(filter(None, map(_squeeze, headers)))
    return _squeeze(title), header_text, [_squeeze(p) for p in paragraphs], _squeeze(body)


def _link_reader(url: str) -> tuple[Callable[[re.Match], None], list[str]]:
    """What reads the anchors of a page from its marks, and the list it adds their targets to."""
    targets: list[str] = []
    base, base_seen = url, False

    def visit(found: re.Match) -> None:
        nonlocal base, base_seen
        name = (found["name"] or "").lower()
        if found["end"] or name not in ("a", "base"):
            return
        href = HREF.search(found["attrs"])
        if not href:
            return
        try:
            target = urljoin(base, unescape(next(g for g in href.groups() if g is not None)).strip())
        except ValueError:
            return
        if name == "a":
            targets.append(target)
        elif not base_seen:
            base, base_seen = target, True

    return visit, targets


def read_links(url: str, html: str) -> list[str]:
    """Absolute targets of all anchors that carry an href."""
    visit, targets = _link_reader(url)
    for found in _markup(html):
        visit(found)
    return targets


def read_page(url: str | None, html: str) -> tuple[str, str, list[str], str, list[str]]:
    """Fields and anchor targets of a page in one pass; a page without a URL has no targets."""
    if url is None:
        return (*read_fields(html), [])
    visit, targets = _link_reader(url)
    return (*read_fields(html, visit), targets)


@F.pandas_udf(PAGE_FIELDS)
def _page_fields(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        [read_fields(page or "") for page in html], columns=PAGE_FIELDS.fieldNames()
    )


@F.pandas_udf(WHOLE_PAGE)
def _whole_page(url: pd.Series, html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        [read_page(u, page or "") for u, page in zip(url, html)], columns=WHOLE_PAGE.fieldNames()
    )


@F.pandas_udf(ArrayType(StringType()))
def _page_links(url: pd.Series, html: pd.Series) -> pd.Series:
    return pd.Series([read_links(u or "", page or "") for u, page in zip(url, html)], dtype=object)


def is_plain(text: Column) -> Column:
    """No markup, no references, no white space but that which ``SPACE`` names."""
    return F.coalesce(~F.rlike(text, F.lit(NOT_PLAIN)), F.lit(False))


def plain_fields(text: Column) -> dict[str, Column]:
    """The fields of a plain text, which is all body."""
    return {
        "title": F.lit(""),
        "headers": F.lit(""),
        "paragraphs": F.array().cast("array<string>"),
        "body": F.trim(F.regexp_replace(text, SPACE.pattern, " ")),
    }


def page_fields(html: Column) -> Column:
    """Fields of a page; plain texts are read natively and do not travel to Python."""
    plain = is_plain(html)
    native = F.struct(*[value.alias(name) for name, value in plain_fields(html).items()])
    return F.when(plain, native).otherwise(once(_page_fields)(F.when(~plain, html)))


def whole_page(url: Column, html: Column) -> Column:
    """Fields and absolute anchor targets, the markup read once; no targets where ``url`` is null."""
    plain = is_plain(html)
    fields = {**plain_fields(html), "links": F.array().cast("array<string>")}
    native = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.when(plain, native).otherwise(once(_whole_page)(url, F.when(~plain, html)))


def page_links(url: Column, html: Column) -> Column:
    return once(_page_links)(url, html)
