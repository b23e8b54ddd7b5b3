"""Main text of web pages with a style tree per site.

Pages of one host are merged into a tree of element paths (tag and class). A node of the tree is
important when its pages differ, in what they show there (content entropy) or in how they build it
(presentation entropy). Branches that look alike all over a site are noise. What markup names as menus,
adverts, comments and the like has a lower importance, and is noise unless its content makes up for it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.url_filter import host
from pagewright.session import stage

# fixed values: what HTML and common page markup call these things
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr img br".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN = frozenset(
    "head script style noscript template iframe object svg canvas video audio map math select button option "
    "textarea title input datalist".split()
)
SUSPECT = frozenset("form dialog nav menu header footer aside".split())
MAIN = ("article", "main")
NEVER_SUSPECT = frozenset(["html", "body", *MAIN])
SUSPECT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
SUSPECT_NAMES = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar aside ad ads adv advert adverts advertisement "
    "advertising adslot adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended breadcrumb "
    "breadcrumbs pagination pager comment comments disqus respond reply replies discussion widget toolbar skip".split()
)
# words that say no more about an element named as above
PLACE_NAMES = frozenset(
    "site main page top bottom left right primary secondary global box block slot unit list bar section container "
    "wrap wrapper inner outer area links link buttons button form icons items".split()
)
# ends of a path step: the element is named by such words alone, or among others
WHOLLY, PARTLY = "!", "?"
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "body": frozenset(["head"]),
}
SCOPES = frozenset("ul ol dl table article main section div aside nav footer header form body html blockquote".split())

RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# a style node stands for all that is nested deeper than this
MAX_DEPTH = 64
# a node is judged when this many pages of the host have it, and is noise below this importance
MIN_PAGES = 8
MIN_IMPORTANCE = 0.2
# shares of a page's text that a name does not outweigh
MOST, MOST_BESIDE_MAIN = 0.5, 0.8

NODE_SCHEMA = "host string, page long, total long, path string, content long, presentation long, plain long, chars long, outside boolean"
NODE_COLUMNS = [column.split()[0] for column in NODE_SCHEMA.split(", ")]
NODE_TYPES = {name: "int64" for name in ("page", "total", "content", "presentation", "plain", "chars")} | {"outside": "bool"}


def _tag_end(text: str, at: int) -> int:
    """Just behind the ``>`` that ends the tag begun at ``at``, quoted values skipped; -1 if none."""
    close = text.find(">", at)
    quote = -1
    if close >= 0 and ("=" in text[at:close]):
        quote = at
        while True:
            found = [q for q in (text.find('"', quote, close), text.find("'", quote, close)) if q >= 0]
            if not found:
                break
            first = min(found)
            if text[first - 1] not in "= \t\n\r\f":
                quote = first + 1
                continue
            end = text.find(text[first], first + 1)
            if end < 0:
                return close + 1
            quote = end + 1
            if quote > close:
                close = text.find(">", quote)
                if close < 0:
                    return -1
    return close + 1 if close >= 0 else -1


def _tokens(text: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): kind is text, open or close; one forward pass, whatever is left open."""
    at, size = 0, len(text)
    gone: set[str] = set()  # end marks that the rest of the text does not hold
    while at < size:
        mark = text.find("<", at)
        if mark < 0:
            yield "text", "", text[at:]
            return
        if mark > at:
            yield "text", "", text[at:mark]
        if text.startswith("<!--", mark) and "-->" not in gone:
            end = text.find("-->", mark + 4)
            if end < 0:
                gone.add("-->")
                end = text.find(">", mark) - 2
            at = end + 3 if end >= mark else size
            continue
        if text.startswith(("<!", "<?"), mark):
            end = text.find(">", mark)
            at = end + 1 if end >= 0 else size
            continue
        tag = TAG.match(text, mark)
        if tag is None:
            yield "text", "", "<"
            at = mark + 1
            continue
        end = _tag_end(text, tag.end()) if ">" not in gone else -1
        if end < 0:  # an unfinished tag at the end of the page shows nothing
            return
        name = tag[2].lower()
        yield ("close" if tag[1] else "open"), name, text[tag.end() : end - 1]
        at = end
        if not tag[1] and name in RAW and name not in gone:
            found = RAW_END[name].search(text, at)
            if found:
                at = found.start()
            else:
                gone.add(name)


def _named(attributes: str) -> tuple[str, str]:
    """(first class for the path, mark: how class, id or role name something that is no main text)."""
    style, mark = "", ""
    for kind, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        if kind.lower() == "role":
            mark = WHOLLY if value.strip().lower() in SUSPECT_ROLES else mark
            continue
        names = value.split() if kind.lower() == "class" else [value]
        if kind.lower() == "class":
            style = names[0].rstrip(WHOLLY + PARTLY) if names else ""
        for name in names:
            words = {word.lower() for word in NAME_PARTS.findall(name)}
            if words & SUSPECT_NAMES and mark != WHOLLY:
                mark = WHOLLY if words <= SUSPECT_NAMES | PLACE_NAMES else PARTLY
    return style, mark


class Block(NamedTuple):
    """A block of text: its ``path`` holds tag, first class and mark of each element around it, ``main``
    numbers the outermost ``article`` or ``main`` around it (0: none), ``plain`` counts its characters
    outside links."""

    path: tuple[str, ...]
    text: str
    main: int
    plain: int


def blocks(page: str) -> list[Block]:
    """Each block of shown text in page order; character references decoded, white space one space.

    An ``article`` in an element marked as no main text (a comment, a teaser) is not counted as main.
    Text that stands right in an element that also holds an ``article`` or ``main`` gets a further,
    empty step, so that it can be told from the element as a whole.
    """
    found: list[Block] = []
    stack: list[tuple[str, str, bool, bool, int]] = []  # tag, path step, hidden, marked, main
    parts: list[str] = []
    still_open: Counter[str] = Counter()
    mains, linked, link = 0, 0, -1  # link: depth of the stack where a link was opened

    def leave(at: int) -> None:
        nonlocal link
        still_open.subtract(step[0] for step in stack[at:])
        del stack[at:]
        if at < link:
            link = -1

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            _, _, hidden, _, main = stack[-1] if stack else ("", "", False, False, 0)
            if text and not hidden:
                outer = [step for tag, step, *_ in stack[:MAX_DEPTH] if tag not in INLINE or step.endswith(WHOLLY)]
                found.append(Block(tuple(outer), text, main, max(0, len(text) - linked)))
        linked = 0

    for kind, name, rest in _tokens(page):
        if kind == "text":
            parts.append(rest)
            if link >= 0:
                linked += len(rest)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            link = len(stack) if kind == "open" else -1
        if kind == "open":
            style, mark = _named(rest) if "=" in rest else ("", "")
            if name in INLINE and mark != WHOLLY:
                continue
            flush()
            closed = frozenset() if name in INLINE else CLOSES.get(name, frozenset()) | {"p"}
            if any(still_open[tag] for tag in closed):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in closed:
                        leave(i)
                        break
                    if stack[i][0] in SCOPES:
                        break
            if name in VOID or rest.endswith("/") and name not in RAW:
                continue
            _, _, hidden, marked, main = stack[-1] if stack else ("", "", False, False, 0)
            hidden = hidden or name in HIDDEN
            if name in NEVER_SUSPECT:
                mark = ""
            elif name in SUSPECT and not (name == "header" and main):
                mark = WHOLLY
            marked = marked or mark == WHOLLY
            if not main and not hidden and name in MAIN and not (name == "article" and marked):
                mains += 1
                main = mains
            stack.append((name, (f"{name}.{style}" if style else name) + mark, hidden, marked, main))
            still_open[name] += 1
        else:
            if name in INLINE and not still_open[name]:
                continue
            flush()
            if still_open[name]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
    flush()
    holders = _holders(found)
    return [b._replace(path=(*b.path, "")) if not b.main and b.path in holders else b for b in found]


def _holders(found: list[Block]) -> set[tuple[str, ...]]:
    """Paths of the elements around an ``article`` or ``main``."""
    holders = set()
    for path in {b.path for b in found if b.main}:
        inner = next((i for i, step in enumerate(path) if step.split(".")[0] in MAIN), len(path))
        holders.update(path[:depth] for depth in range(inner + 1))
    return holders


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def page_nodes(found: list[Block]) -> list[tuple[str, int, int, int, int, bool]]:
    """(path, content, presentation, plain, chars, outside) of each style node of a page.

    Content is a digest of all text below the node, presentation one of the element kinds below it,
    ``plain`` and ``chars`` its characters outside links and all of them. ``outside`` says that the
    page has an ``article`` or ``main`` which is neither in the node nor around it.
    """
    holders = _holders(found)
    below: dict[tuple[str, ...], tuple[list[str], list[str]]] = {}
    sizes: Counter[tuple[str, ...]] = Counter()
    plains: Counter[tuple[str, ...]] = Counter()
    outside = {}
    for path, text, main, plain in found:
        for depth in range(1, len(path) + 1):
            node = path[:depth]
            texts, styles = below.setdefault(node, ([], []))
            texts.append(text)
            style = "/".join(path[depth:])
            if not styles or styles[-1] != style:
                styles.append(style)
            sizes[node] += len(text)
            plains[node] += plain
            outside[node] = bool(holders) and not main and node not in holders
    return [
        ("/".join(p), _digest("\n".join(t)), _digest("\n".join(s)), plains[p], sizes[p], outside[p])
        for p, (t, s) in below.items()
    ]


def _spoken(found: list[Block], noise: frozenset[str], kept: frozenset[str]) -> list[Block]:
    """Blocks that are neither at a noise path nor in a branch that its name tells against.

    A marked branch stays when it holds an ``article`` or ``main`` or is among the ``kept`` paths. If the
    site does not tell, it stays with more than half of the page's text outside links, beside an
    ``article`` or ``main`` with four fifths; one that is marked in part also if most of its text is
    outside links.
    """
    holders, mains = _holders(found), any(b.main for b in found)
    sizes: Counter[tuple[str, ...]] = Counter()
    plains: Counter[tuple[str, ...]] = Counter()
    for b in found:
        plains[()] += b.plain
        for depth, step in enumerate(b.path, 1):
            if step.endswith((WHOLLY, PARTLY)):
                sizes[b.path[:depth]] += len(b.text)
                plains[b.path[:depth]] += b.plain

    def stays(node: tuple[str, ...]) -> bool:
        marked = node[-1].endswith((WHOLLY, PARTLY))
        if marked and node in holders:
            return True
        if noise and "/".join(node) in noise:
            return False
        if not marked or "/".join(node) in kept:
            return True
        beside = mains and not any(step.split(".")[0] in MAIN for step in node)
        if plains[node] > plains[()] * (MOST_BESIDE_MAIN if beside else MOST):
            return True
        return node[-1].endswith(PARTLY) and 2 * plains[node] >= sizes[node]

    good = {path: all(stays(path[:depth]) for depth in range(1, len(path) + 1)) for path in {b.path for b in found}}
    return [b for b in found if good[b.path]]


def _chosen(found: list[Block], noise: frozenset[str], kept: frozenset[str]) -> list[str]:
    """Texts of the blocks of main text."""
    spoken = _spoken(found, noise, kept)
    inside = Counter()
    for b in spoken:
        if b.main:
            inside[b.main] += b.plain
    if not inside:
        return [b.text for b in spoken]
    largest, holders = max(inside.values()), _holders(found)

    def branch(path: tuple[str, ...]) -> tuple[str, ...]:
        return next((path[:d] for d in range(1, len(path) + 1) if path[:d] not in holders), path)

    outer = Counter()
    for b in spoken:
        if not b.main:
            outer[branch(b.path)] += b.plain
    whole = {at for at, plain in outer.items() if plain > largest or "/".join(at) in kept}
    return [b.text for b in spoken if b.main or branch(b.path) in whole]


def main_text(page: str, noise: frozenset[str] = frozenset(), kept: frozenset[str] = frozenset()) -> str:
    """The page's blocks of main text, one per line.

    Blocks at ``noise`` paths of the site are out, inside and outside an ``article`` or ``main``, and so
    are those named as something else, unless their branch holds too much to be that. If a page has one of these with text, a branch outside stays when it is
    among the ``kept`` paths of the site or holds more text outside links than each of them.
    """
    return "\n".join(_chosen(blocks(page), noise, kept))


def _entropy(of: str) -> Column:
    """Entropy of the counts ``of`` in units of log(their sum): 0 all alike, 1 all different."""
    n, total = F.col(of), F.sum(of)
    return F.round((F.log(total) - F.sum(n * F.log(n)) / total) / F.log(total), 9)


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance, support) of the nodes of each host's style tree.

    Pages of a host with the same main text count once, so a copied article is not taken for something
    that a site repeats. ``importance`` is the larger entropy of content and presentation, twice that
    inside ``article`` or ``main``; for a marked node it is its support. ``support`` is what speaks for
    a node in spite of its name or place: a wholly marked one has the content entropy times its share of
    the pages' text, one marked in part or beside ``article`` and ``main`` half the content entropy less
    its part of links; null for others. Counts are made per (host, path, content) first, so a host
    with a third of all pages is spread over its contents and merged from partial sums.
    """

    def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for site, page in zip(batch["host"], batch["html"], strict=True):
                found = blocks(page or "")
                own = _digest("\n".join(_chosen(found, frozenset(), frozenset()) or [b.text for b in found]))
                total = sum(b.plain for b in found)
                rows += [(site, own, total, *node) for node in page_nodes(found)]
            yield pd.DataFrame(rows, columns=NODE_COLUMNS).astype(NODE_TYPES)

    seen = stage(
        pages.select(host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
        .mapInPandas(nodes, NODE_SCHEMA)
        .groupBy("host", "path", "page")
        .agg(*(F.min(c).alias(c) for c in ("content", "presentation", "plain", "chars", "total")), F.max("outside").alias("outside")),
        "style-nodes",
    )

    def entropy(of: str, *sums: str) -> DataFrame:
        counted = seen.groupBy("host", "path", of).agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in sums))
        return (
            counted.groupBy("host", "path")
            .agg(F.sum("n").alias("pages"), _entropy("n").alias(of), *(F.sum(c).alias(c) for c in sums))
            .where(F.col("pages") >= MIN_PAGES)
        )

    seen = seen.withColumn("outside", F.col("outside").cast("long"))
    shown, built = entropy("content", "plain", "chars", "total", "outside"), entropy("presentation").drop("pages")
    raised = F.when(F.col("path").rlike(r"(^|/)(article|main)([./]|$)"), 2.0).otherwise(1.0)
    wholly, partly = F.endswith("path", F.lit(WHOLLY)), F.endswith("path", F.lit(PARTLY))
    half = 0.5 * F.col("content") * F.col("plain") / F.col("chars")
    support = (
        F.when(wholly, raised * F.col("content") * F.try_divide("plain", "total"))
        .when(partly, raised * half)
        .when(F.col("outside") > 0, half)
    )
    importance = F.when(wholly | partly, F.coalesce(support, F.lit(0.0))).otherwise(
        raised * F.greatest("content", "presentation")
    )
    return shown.join(built, ["host", "path"]).select(
        "host", "path", "pages", importance.alias("importance"), support.alias("support")
    )


def extract_text(pages: DataFrame, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """(page_id, url, text) of every row of ``pages(page_id, url, html)``.

    A null page is empty, an empty page has an empty text. Null URLs and those without ``://`` form
    one site. Repeated rows are each read. Unclosed tags, comments and quotes end with the page; the
    parser goes forward once. A node that fewer than ``MIN_PAGES`` pages of a site have is never
    noise. No pages give no rows; further columns are ignored.
    """
    noisy, important = F.col("importance") < min_importance, F.col("support") >= min_importance
    tree = style_tree(pages).where(noisy | important)
    # written, so that the planner broadcasts it only when its measured size is small
    judged = stage(
        tree.groupBy("host").agg(
            F.collect_list(F.when(noisy, F.col("path"))).alias("noise"),
            F.collect_list(F.when(important, F.col("path"))).alias("kept"),
        ),
        "noise",
    )
    sited = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host(F.col("url")).alias("host"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                main_text(page or "", *(frozenset(paths) if paths is not None else frozenset() for paths in judged))
                for page, *judged in zip(batch["html"], batch["noise"], batch["kept"], strict=True)
            ]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    types = dict(sited.dtypes)
    return (
        sited.join(judged, "host", "left")
        .select("page_id", "url", "html", "noise", "kept")
        .mapInPandas(read, f"page_id {types['page_id']}, url {types['url']}, text string")
    )
