"""Main text of web pages by consensus paths of their hosts.

A page is read as blocks of text inside containers.  A container's path is the chain of tag and class names from the root, with
digits generalised, so that the pages of one template share it.  Each page scores its containers by the running text
they hold; a host's pages vote with these scores, and every page is then extracted from the container its host
prefers among those it has.  The score finds where the running text is densest; an article in several containers is wider, so
what is extracted is the article around it: the element or named container that holds it, or the one that holds the heading.

Reading, scoring and extracting take time and memory in proportion to the page, whatever its markup: tags are read by a
scanner that never goes back, paths are kept as digests, scores pass from containers to those around them in one turn.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.llm.tables import ascii_lower, materialise, sliced

# Element names of HTML by their role here.
CONTAINERS = frozenset("body div article main section td center blockquote details".split())
ASIDE = frozenset("nav footer aside form dialog menu header".split())
MUTE = frozenset("script style noscript template svg iframe textarea title object canvas xmp noembed noframes audio video select button".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe noscript".split())
BLOCKS = CONTAINERS | ASIDE | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption pre figure figcaption hr address fieldset hgroup html head summary legend option search".split())
SPACED = frozenset("br td th".split())
#: Class, id and role words that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus "
    "footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination popup popular promo promos promotion "
    "related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets "
    "complementary contentinfo alert dialog".split()
)
#: Names that begin so tell what a page has or is, not what the element holds.
STATES = ("has-", "with-", "without-", "no-", "is-")
#: Elements that are closed by the begin of another one: these open ones by each of these.
CLOSERS = {
    **{tag: frozenset([tag]) for tag in ("p", "li", "option")},
    **{tag: frozenset(["td", "th"]) for tag in ("td", "th")}, **{tag: frozenset(["dd", "dt"]) for tag in ("dd", "dt")},
    **{tag: frozenset(["td", "th", "tr"]) for tag in ("tr", "thead", "tbody", "tfoot")},
}
#: Text of the article's own whatever its names are.
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 li td th dd dt pre figcaption caption".split())
#: These mark a page's head, unless they stand inside the article.
HEADS = frozenset("header head".split())
ARTICLE = frozenset("article main".split())

#: Class and id words of an article's container, unless they stand with words that mark a list of them.
NAMED = frozenset("article post entry story hentry".split())
LISTS = frozenset("list lists grid feed archive posts articles entries stories recent latest teaser teasers page wrap wrapper container layout site".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_BLANK = re.compile(r"[\s/]*")
_KEY = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_PLAIN_VALUE = re.compile(r"[^\s>]*")
#: Attributes that say what an element is.
TELLING = frozenset("class id role hidden style aria-hidden".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


class Scanner:
    """Reads a page from left to right; what has not been found once is not looked for again."""

    def __init__(self, page: str):
        self.page, self.missing = page, set()

    def find(self, mark: str, at: int) -> int:
        """Next place of ``mark``, or -1."""
        place = -1 if mark in self.missing else self.page.find(mark, at)
        if place < 0:
            self.missing.add(mark)
        return place

    def attributes(self, at: int) -> tuple[dict[str, str], bool, int]:
        """Telling attributes of a tag, whether it closes itself, and the place after it.

        A quote delimits a value only right after ``=``, and only if it is closed; elsewhere it is a character.
        """
        page, end, found = self.page, len(self.page), {}
        while True:
            blank = _BLANK.match(page, at)
            at = blank.end()
            if at >= end or page[at] == ">":
                return found, blank.group().endswith("/"), at + 1
            key = _KEY.match(page, at)
            at, value = key.end(), ""
            equals = _EQUALS.match(page, at)
            if equals:
                at = equals.end()
                quote = page[at : at + 1]
                close = self.find(quote, at + 1) if quote in ("'", '"') else -1
                if close >= 0:
                    value, at = page[at + 1 : close], close + 1
                else:
                    plain = _PLAIN_VALUE.match(page, at)
                    value, at = plain.group(), plain.end()
            if len(key.group()) <= 11 and (name := key.group().lower()) in TELLING:
                found.setdefault(name, value)

    def tokens(self) -> Iterator[tuple[str, str, dict[str, str], bool]]:
        """(kind, text or tag, attributes, closes itself): kind is ``text``, ``open`` or ``close``; raw elements and comments are left out."""
        page, at, end = self.page, 0, len(self.page)
        while at < end:
            mark = self.find("<", at)
            if mark < 0:
                yield "text", page[at:], {}, False
                return
            if mark > at:
                yield "text", page[at:mark], {}, False
            at, after = mark, page[mark + 1 : mark + 2]
            name = _NAME.match(page, mark + 2 if after == "/" else mark + 1)
            if name:
                tag = name.group().lower()
                found, own, at = self.attributes(name.end())
                yield "close" if after == "/" else "open", tag, found, own
                if tag in RAW and after != "/":
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at) if tag not in self.missing else None
                    if close is None:
                        return
                    at = close.start()
            elif page.startswith("<![CDATA[", mark) and (close := self.find("]]>", mark)) >= 0:
                yield "text", page[mark + 9 : close], {}, False
                at = close + 3
            elif page.startswith("<!--", mark):
                close = self.find("-->", mark + 2)
                at = close + 3 if close >= 0 else end
            elif after in ("!", "?", "/"):
                close = self.find(">", mark)
                at = close + 1 if close >= 0 else end
            else:
                yield "text", "<", {}, False
                at = mark + 1


@dataclass(eq=False)
class Node:
    """An open or closed container; ``off`` tells that it is not article text, ``own`` and ``score`` hold its text's weight.

    ``named`` tells that its names are an article's, ``headed`` that a first-level heading stands in it.
    """

    tag: str
    path: str
    off: bool
    within: bool
    parent: Node | None
    score: float = 0.0
    named: bool = False
    headed: bool = False
    chosen: bool = False


def _marks(attributes: dict[str, str]) -> tuple[str, set[str], bool]:
    """First class name, all words of class and role and the id as one word, whether the element is hidden."""
    classes = attributes.get("class", "").split()
    words = {w.lower() for one in (*classes, *attributes.get("role", "").split()) if not one.lower().startswith(STATES) for w in _WORDS.findall(one)}
    words.add(attributes.get("id", "").strip().lower())
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    return classes[0] if classes else "", words, hidden


def parse(page: str) -> tuple[list[Node], list[tuple[str, Node, float]]]:
    """Containers in page order, outer ones first, and blocks (text, container, share of its text in links) outside of boilerplate."""
    root = Node("", "", False, False, None)
    nodes, blocks = [root], []
    top, pieces, linked, link, heading = root, [], 0, False, False
    open_tags: Counter[str] = Counter()

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text and not top.off:
                blocks.append((text, top, min(1.0, linked / len(text))))
                # A heading that is a link names the site.
                node = top if heading and 2 * linked < len(text) else None
                while node is not None and not node.headed:
                    node.headed, node = True, node.parent
        pieces, linked = [], 0

    def leave(node: Node) -> Node:
        """The container around ``node``, with it and all that is open in it closed."""
        inner = top
        while inner is not node.parent:
            open_tags[inner.tag] -= 1
            inner = inner.parent
        return node.parent

    for kind, tag, attributes, alone in Scanner(page).tokens():
        if kind == "text":
            pieces.append(tag)
            if link:
                linked += len(tag)
            continue
        closing = kind == "close"
        if tag in RAW and tag != "title" and not closing:
            continue
        if tag == "a":
            link = not closing
        if tag in SPACED:
            pieces.append(" ")
        if tag not in BLOCKS and tag not in MUTE:
            continue
        if tag in BLOCKS:
            flush()
            heading = tag == "h1" and not closing
            if not closing:
                while top.tag == "p" or top.tag in CLOSERS.get(tag, ()):
                    top = leave(top)
        if closing:
            if open_tags[tag] > 0:
                node = top
                while node.tag != tag and (tag in CONTAINERS or tag in ASIDE or tag in MUTE or node.tag not in CONTAINERS):
                    node = node.parent
                if node.tag == tag:
                    flush()
                    top = leave(node)
        elif not alone and tag not in RAW and (tag in CONTAINERS or tag in ASIDE or tag in MUTE or attributes):
            name, words, hidden = _marks(attributes)
            said = tag not in ARTICLE and tag not in TEXTUAL and tag not in ("html", "body") and bool(words & BOILERPLATE)
            off = top.off or hidden or tag in MUTE or said
            if tag in ASIDE:
                off = off or tag != "header" or not top.within
            if words & HEADS and not top.within and tag not in ARTICLE and tag not in TEXTUAL and tag not in ("html", "body"):
                off = True
            if tag in CONTAINERS or off:
                flush()
                step = tag + ("." + _DIGITS.sub("0", name) if name else "")
                path = top.path if tag == "body" else hashlib.blake2b(f"{top.path}/{step}".encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
                top = Node(tag, path, off, top.within or tag in ARTICLE, top, named=bool(words & NAMED) and not words & LISTS)
                open_tags[tag] += 1
                nodes.append(top)
    flush()
    return nodes, blocks


def scored(page: str) -> tuple[list[Node], list[tuple[str, Node, float]]]:
    """As ``parse``, with scores: a block counts fully for its container and half for each level above it."""
    nodes, blocks = parse(page)
    for text, node, links in blocks:
        node.score += (1 - links) ** 2 * len(text) * (1.25 if node.within else 1.0)
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.score += node.score / 2
    return nodes, blocks


def votes(page: str | None) -> dict[str, float]:
    """Share of the best score of each container path of a page, from a third on."""
    if not page:
        return {}
    nodes, _ = scored(page)
    most = max((n.score for n in nodes), default=0.0)
    shares: dict[str, float] = defaultdict(float)
    for node in nodes:
        if most > 0 and node.score * 3 >= most:
            shares[node.path] = max(shares[node.path], node.score / most)
    return shares


def around(nodes: list[Node]) -> dict[Node, tuple[Node | None, Node | None, Node | None]]:
    """For each container the nearest ones above it, below the body: an article element, one with an article's name, one with a heading."""
    found: dict[Node, tuple[Node | None, Node | None, Node | None]] = {}
    for node in nodes:
        up = node.parent
        if up is None or up.tag in ("body", ""):
            found[node] = (None, None, None)
        else:
            article, named, headed = found[up]
            found[node] = (up if up.tag == "article" else article, up if up.named else named, up if up.headed else headed)
    return found


def whole(node: Node, above: dict[Node, tuple[Node | None, Node | None, Node | None]]) -> Node:
    """The container of the whole article that ``node`` has text of: the nearest article element above it; else, if no heading
    is in it, the nearest container with an article's name, and if none is in that either, the nearest one with a heading."""
    article, named, _ = above[node]
    if node.tag == "article":
        return node
    if article is not None:
        return article
    if node.headed:
        return node
    node = named or node
    return node if node.headed else above[node][2] or node


def extract(page: str | None, ranking: list[str]) -> str:
    """Text of the articles around the containers at the first path of ``ranking`` that the page has with text, else at its own best path."""
    if not page:
        return ""
    nodes, blocks = scored(page)
    if not blocks:
        return ""
    paths = {n.path for n in nodes if n.score > 0}
    path = next((p for p in ranking if p in paths), None)
    if path is None:
        path = max(nodes, key=lambda n: n.score).path
    above = around(nodes)
    for node in nodes:
        if node.path == path and node.score > 0:
            whole(node, above).chosen = True
    for node in nodes:
        node.chosen = node.chosen or (node.parent is not None and node.parent.chosen)
    return "\n\n".join(text for text, node, _ in blocks if node.chosen)


def host_of(url: Column) -> Column:
    """Host after the first ``://``, lower-cased; empty without one."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([^/?#]*)", 1))


def consensus(pages: DataFrame, least: float = 0.3) -> DataFrame:
    """(host, ranking): a host's paths by votes, those with at least ``least`` of the most.

    A path that a host prefers has votes from many pages, so the list is bounded by templates, not by pages; votes are summed
    per task before they are shuffled.
    """

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, paths, shares = [], [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            for path, share in votes(page).items():
                hosts.append(host)
                paths.append(path)
                shares.append(share)
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.float64())], ["host", "path", "share"])

    cast = pages.select(host_of(F.col("url")).alias("host"), "html").where("html IS NOT NULL").mapInArrow(sliced(vote), "host string, path string, share double")
    summed = cast.groupBy("host", "path").agg(F.sum(F.pow("share", F.lit(4.0))).alias("votes"))
    most = summed.groupBy("host").agg(F.max("votes").alias("most"))
    best = summed.join(most, "host").where(F.col("votes") >= least * F.col("most"))
    order = F.sort_array(F.collect_list(F.struct((-F.round("votes", 6)).alias("votes"), "path")))
    return best.groupBy("host").agg(order["path"].alias("ranking"))


def main_text(pages: DataFrame, **options) -> DataFrame:
    """page_id, url, text for every row of ``pages`` (page_id, url, html; other columns ignored).

    Blocks are joined by empty lines, white space inside a block is one blank, character references are decoded.  Null and
    empty html, and pages without article text, give "".  Pages without a host share the empty one.  Repeated rows each come
    back; an empty table gives an empty result.
    """
    pages = pages.select("page_id", "url", "html")
    rankings = materialise(consensus(pages, **options), "host-paths")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(page, ranking or []) for page, ranking in zip(batch.column("html").to_pylist(), batch.column("ranking").to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    with_paths = pages.withColumn("host", host_of(F.col("url"))).join(rankings, "host", "left").select("page_id", "url", "html", "ranking")
    kind = pages.schema["page_id"].dataType.simpleString()
    return with_paths.mapInArrow(sliced(work), f"page_id {kind}, url string, text string")
