"""Main text of HTML pages by consensus of each host's pages.

Every page is parsed leniently and its containers are scored by the text that stands in them, much as a reader
would: full weight for blocks of their own, less for those of inner containers, none for links. A container is
named by its generalised path of tags and classes. Spark sums the pages' votes per host and path, the path with
the most votes wins, and the pages are read again at the winning path of their host. The winners go to all tasks
while their names take ``BROADCAST_BYTES`` at most; beyond that pages meet them by host, and those of a host that
holds a large share of all in many tasks. A page that lacks it falls
back on its own best container. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by tag, role and class on the way. A class or id counts by its whole words or the word it
begins with, and not where the page's main text stands inside the element that has it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import map_rows
from comanda.llm.url_filter import url_parts
from comanda.operators.heavy import join_heavy
from comanda.staging import stage

# Hosts and paths that are sent to every task; more meet the pages in a salted join.
BROADCAST_BYTES = 8 * 1024**2

# HTML elements by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "head nav header footer aside form script style noscript template iframe button select option textarea "
    "input canvas dialog menu title datalist audio video".split()
)
CONTAINERS = frozenset("body main article section div td".split())
FOREIGN = frozenset("svg math".split())
# Tags that end an svg or math element left open.
BREAKOUT = frozenset("article blockquote body div dl h1 h2 h3 h4 h5 h6 li main ol p pre section table ul".split())
INLINE = frozenset(
    "svg math object a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# What a start tag closes if it is open further in: (tags, those at which the search stops).
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
# Words of class and id values that mark what is not the article.
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar aside ad ads advert adverts advertisement "
    "advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "comment comments disqus respond share sharing social related recommended breadcrumb breadcrumbs newsletter "
    "subscribe subscription popup modal overlay widget pagination pager toolbar login signup skip".split()
)
# Where a header is that of the article, not of the site.
ARTICLE_TAGS, ARTICLE_WORDS = frozenset("article main section".split()), frozenset("article post entry story".split())
# Words before a dropped word that make it no less the site's: site-header.
SITE_WORDS = frozenset("site global".split())
CONTENT_WORDS = frozenset("content article post entry story text body main".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[a-z]+")
INNER_WEIGHT = 0.5
HELD_BONUS = 0.5
VOTE_SHARE = 0.3


@dataclass
class Container:
    """An element that may hold the article, with the blocks below it counted so far."""

    path: str
    bonus: float
    parent: Container | None
    own: int = 0
    inner: float = 0.0
    blocks: list[str] = field(default_factory=list)

    @property
    def score(self) -> float:
        return (self.own + self.inner) * self.bonus


@dataclass
class Open:
    """An open element of the page."""

    tag: str
    step: str
    container: Container | None
    dropped: bool
    link: bool
    named: Named | None = None  # the innermost element that a class or id marks
    anchor: Anchor | None = None
    article: bool = False
    code: bool = False
    foreign: bool = False


@dataclass
class Named:
    """An element that a class or id marks as no article, the one around it, and the text that stands in no inner one."""

    place: int
    parent: Named | None
    depth: int
    chars: int = 0


@dataclass
class Anchor:
    """An element that is likely to hold the main text, inside a marked one or not."""

    rank: int  # 0 main, 1 article, 2 by name
    named: Named | None
    parent: Anchor | None
    chars: int = 0


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _is_dropped(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether tag, role or state say that an element is no part of the article."""
    if tag in DROPPED and not (tag == "header" and in_article):
        return True
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _roles(attributes: dict[str, str]) -> set[str]:
    """What the class and id names begin with."""
    roles = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = NAME_PART.findall(name)
        if parts:
            roles.add(parts[1] if parts[0] in SITE_WORDS and len(parts) > 1 else parts[0])
    return roles


def _anchor_rank(tag: str, attributes: dict[str, str], roles: set[str]) -> int | None:
    role = attributes.get("role", "").lower()
    if "main" in (tag, role):
        return 0
    if not DROPPED_WORDS.isdisjoint(roles):
        return None
    if "article" in (tag, role):
        return 1
    return 2 if tag in CONTAINERS and not CONTENT_WORDS.isdisjoint(roles) else None


def _step(tag: str, attributes: dict[str, str]) -> str:
    """Tag and classes without digits, so that numbered classes fall together."""
    classes = sorted({re.sub(r"\d+", "", c) for c in attributes.get("class", "").lower().split()} - {""})
    return ".".join((tag, *classes))


def _bonus(tag: str, attributes: dict[str, str]) -> float:
    if tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article"):
        return 2.0
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    return 1.0 if CONTENT_WORDS.isdisjoint(NAME_PART.findall(names)) else 1.5


class Page:
    """The containers of a page in page order, each with the blocks of all its depth."""

    def __init__(self, html: str):
        self.held: set[int] = set()
        self.read(html)
        self.held = self.holders()
        if self.held:
            self.read(html)

    def read(self, html: str) -> None:
        root = Container("html", 0.5, None)
        self.containers = [root]
        self.stack = [Open("html", "html", root, False, False)]
        self.anchors: list[Anchor] = []
        self.marked = self.kept_chars = 0
        self.words: list[str] = []
        self.link_chars = 0
        at = mark = 0
        while (mark := html.find("<", mark)) >= 0:
            tag = TAG.match(html, mark)
            if not tag:  # a plain character
                mark += 1
                continue
            self.text(html[at:mark])
            at = mark = tag.end()
            name = (tag[2] or tag[5] or "").lower()
            if not name:
                continue
            if tag[1] or tag[4]:
                self.end(name)
                continue
            rest = tag[3] if tag[2] else tag[6]
            self.begin(name, rest or "")
            if name in RAW_TEXT and not (rest or "").rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = mark = close.end() if close else len(html)
                self.end(name)
        self.text(html[at:])
        self.flush()

    def text(self, raw: str) -> None:
        here = self.stack[-1]
        if not raw or here.dropped:
            return
        if not here.link:
            chars = len(raw.strip())
            if here.named:
                here.named.chars += chars
            else:
                self.kept_chars += chars
            if here.anchor and here.anchor.named is here.named:
                here.anchor.chars += chars
        if not here.named:
            self.words.append(raw)
            if here.link:
                self.link_chars += len(raw.strip())

    def holders(self) -> set[int]:
        """Places of the marked elements that hold the main text, so that they stay.

        Those are the ones around ``main``, and around an article with more text than is kept without it. A name
        counts like an article where no other sign of the main text is kept.
        """
        for anchor in reversed(self.anchors):  # inner ones first
            if anchor.parent and anchor.parent.named is anchor.named:
                anchor.parent.chars += anchor.chars
        held: set[int] = set()
        kept, found = self.kept_chars, any(a.named is None and a.chars for a in self.anchors)
        by_level: dict[tuple[bool, int, int], list[Anchor]] = {}  # main first, then the outer ones
        for anchor in self.anchors:
            if anchor.named and anchor.chars:
                by_level.setdefault((anchor.rank > 0, anchor.named.depth, anchor.rank), []).append(anchor)
        for (*_, rank), level in sorted(by_level.items(), key=lambda pair: pair[0]):
            chosen = [a for a in level if rank == 0 or (a.chars > kept and not (rank == 2 and found))]
            for anchor in chosen:
                found, named = True, anchor.named
                while named and named.place not in held:
                    held.add(named.place)
                    kept += named.chars
                    named = named.parent
        return held

    def flush(self) -> None:
        """Ends the block: its text goes to the nearest container and to those around it."""
        if not self.words:
            return
        block = " ".join(unescape("".join(self.words)).split())
        chars = max(0, len(block) - self.link_chars)
        self.words, self.link_chars = [], 0
        if not block:
            return
        container, weight = self.stack[-1].container, 1.0
        if container:
            container.own += chars
        while container:
            container.blocks.append(block)
            container = container.parent
            weight *= INNER_WEIGHT
            if container:
                container.inner += chars * weight

    def begin(self, tag: str, rest: str) -> None:
        if tag == "html":
            return
        if self.stack[-1].foreign and tag in BREAKOUT:
            while self.stack[-1].foreign:
                self.stack.pop()
        if tag == "br" or (tag == "text" and self.stack[-1].foreign):
            self.space()
        if tag == "br":
            return
        foreign = self.stack[-1].foreign or tag in FOREIGN
        if tag not in INLINE and not foreign:
            self.flush()
            self.close_before(tag)
        if foreign and rest.rstrip().endswith("/"):
            return
        if tag in VOID:
            return
        attributes = _attributes(rest) if rest.strip() else {}
        above = self.stack[-1]
        dropped = above.dropped or _is_dropped(tag, attributes, above.article)
        named, anchor, held = above.named, above.anchor, False
        article = above.article or tag in ARTICLE_TAGS
        if attributes and not dropped:
            roles = _roles(attributes)
            article = article or not ARTICLE_WORDS.isdisjoint(roles)
            marks = DROPPED_WORDS.intersection(roles)
            if above.article:
                marks -= {"header"}
            if marks and not above.code and tag not in ("body", "html", "main", "article"):
                held = self.marked in self.held
                if not held:
                    named = Named(self.marked, named, named.depth + 1 if named else 1)
                self.marked += 1
        if not dropped and (tag in CONTAINERS or "role" in attributes):
            rank = _anchor_rank(tag, attributes, _roles(attributes))
            if rank is not None:
                anchor = Anchor(rank, named, anchor)
                self.anchors.append(anchor)
        step = f"{above.step}>{_step(tag, attributes)}"
        container = above.container
        if tag in CONTAINERS and not dropped and not named:
            bonus = _bonus(tag, attributes) * (HELD_BONUS if held else 1)
            container = Container(step, bonus, above.container)
            self.containers.append(container)
        link, code = above.link or tag == "a", above.code or tag in ("pre", "code")
        inside = foreign and tag != "foreignobject"
        self.stack.append(Open(tag, step, container, dropped, link, named, anchor, article, code, inside))

    def space(self) -> None:
        here = self.stack[-1]
        if not here.dropped and not here.named:
            self.words.append(" ")

    def close_before(self, tag: str) -> None:
        """Ends what a start tag ends without saying so: an open paragraph, list item or cell."""
        tags, stops = CLOSES.get(tag, (("p",), CONTAINERS - {"body"} | {"td", "th", "li", "table"}))
        for depth in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[depth].tag
            if open_tag in tags:
                del self.stack[depth:]
                return
            if open_tag in stops:
                return

    def end(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                if tag == "text" and self.stack[depth].foreign:
                    self.space()
                if tag not in INLINE and not self.stack[depth].foreign:
                    self.flush()
                del self.stack[depth:]
                return

    def votes(self) -> dict[str, float]:
        """Shares of the best score by path, small ones left out."""
        best = max((c.score for c in self.containers), default=0)
        shares: dict[str, float] = {}
        for container in self.containers:
            if best and container.score >= VOTE_SHARE * best:
                shares[container.path] = max(shares.get(container.path, 0), container.score / best)
        return shares

    def article(self, path: str | None) -> str:
        """Blocks at a path, or in the page's best container where the path is absent or empty."""
        blocks = [b for c in self.outermost(path) for b in c.blocks]
        if not blocks and self.containers:
            blocks = max(self.containers, key=lambda c: (c.score, len(c.path))).blocks
        return "\n".join(blocks)

    def outermost(self, path: str | None) -> list[Container]:
        """Containers at the path. Their steps from the root are equal, so none is inside another."""
        return [c for c in self.containers if c.path == path]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` and ``n_chars``.

    Null and empty pages have an empty text, as have pages without text outside of what is left out. Pages
    without a host vote together. Of paths with equal votes the longer wins, then the first in order. Rows that
    repeat an id, or have none, each give a row; other columns are not read. An empty table gives an empty table.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        url_parts(F.col(url_col))[0].alias("host"),
    )

    def ballots() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(found: list[dict]) -> Iterable[tuple]:
            for row in found:
                for path, share in Page(row["html"] or "").votes().items():
                    yield row["host"], path, share

        return work

    cast = map_rows(rows.select("host", "html"), "host string, path string, share double", ballots)
    counted = cast.groupBy("host", "path").agg(F.sum(F.round("share", 6).cast("decimal(20,6)")).alias("votes"))
    best = F.max(F.struct("votes", F.length("path").alias("n"), "path")).alias("best")
    winners = counted.groupBy(F.col("host").alias("_host")).agg(best).select("_host", F.col("best.path").alias("path"))
    winners = stage(winners, "host-paths").df

    def again() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(found: list[dict]) -> Iterable[tuple]:
            for row in found:
                text = Page(row["html"] or "").article(row["path"])
                yield row["page_id"], row["url"], text, len(text)

        return work

    kind_of_id = pages.schema[id_col].dataType.simpleString()
    names = winners.agg(F.sum(F.octet_length("_host") + F.octet_length("path"))).first()[0] or 0
    if names <= BROADCAST_BYTES:
        chosen = rows.join(F.broadcast(winners), F.col("host").eqNullSafe(F.col("_host")), "left")
    else:
        rows = rows.withColumn("_row", F.xxhash64("page_id", "url", "html"))
        chosen = join_heavy(rows, winners, ["host"], ["_host"], ["_row"], "left")
    chosen = chosen.select("page_id", "url", "html", "path")
    return map_rows(chosen, f"page_id {kind_of_id}, url string, text string, n_chars bigint", again)
