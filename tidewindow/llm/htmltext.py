"""Main text of web pages: site template removal by repeated element subtrees.

A page is read into a tree of elements.  Its subtrees are hashed with their tag, class and id,
and all of their text.  Spark counts in how many different page bodies of the same host each
hash occurs; subtrees in ``MIN_PAGES`` of them are the site's template and are deleted, however
large the host is.  A body is the text that a page has by tags and names alone, so copies of a
page count once and do not make their own text a template.  So are deleted elements
that say themselves that they are no main text: by their tag (menus, footers, asides, forms,
scripts, styles) or by their class, id or role (advert, sidebar, comments, notice): by a whole name, or by a word of one
that says what the element is, as in ``ad-slot`` and not in ``related-work``; an article, section or
main element by a whole name only.

A page with ``article`` elements, or else a ``main`` element, is read from those; but from ``main``
if less than half of what is left of it stands in its articles.  In them the
boxes count: block elements, but paragraphs and headings only with a class, id or role, since
those without are the text itself.  Where more than half of an article's text would go, it is a
near copy of others, not a text with boxes, and nothing is deleted in it.

Text is split at block elements.  White space inside a block becomes one space, blocks are
joined by a line break in page order, and nothing else is dropped.

Defined results: a null or empty page gives an empty text; a null address is a host of its
own; text without any markup is one block; unclosed and stray tags are mended as browsers do
for paragraphs and list items, and otherwise close with the element around them; repeated
rows get the same text; no pages give no rows.  Only the named columns are read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.llm.arrow import slices, texts
from tidewindow.llm.texts import row_key
from tidewindow.session import pin

#: A subtree is template in so many different page bodies of its host.
MIN_PAGES = 3
#: Template hashes that may be broadcast; a row is a number.
BROADCAST_HASHES = 100_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
#: In an article these are boxes only if they have a class, id or role.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 hgroup header li dt dd tr td th tbody thead tfoot caption pre".split())
NO_TEXT = frozenset(
    "head title script style noscript template svg canvas iframe object embed audio video map "
    "nav footer aside form button select option textarea input fieldset dialog menu".split()
)
MARKED = re.compile(
    r"ads?|adverts?|advertis\w*|banners?|sponsor(ed)?|promo\w*|side-?bars?|menus?|nav|navbar|navigation|"
    r"bread-?crumbs?|comments?|disqus|replies|footers?|cookies?|consent|gdpr|notices?|alerts?|share|sharing|"
    r"socials?|related|recommended|subscribe|newsletter|pop-?ups?|modals?|overlay|masthead|toolbar|"
    r"complementary|contentinfo|search"
)
#: After these the rest of a name says what a page is without or has beside it.
BESIDE = frozenset("no not has with without hide".split())
#: Behind a word of the list these still name the same thing: an ad slot is an ad, related work is not.
PLACES = re.compile(
    r"\d+|areas?|bars?|blocks?|bottom|box(es)?|buttons?|cards?|columns?|cols?|containers?|contents?|footers?|forms?|"
    r"frames?|grids?|groups?|headers?|heads?|holders?|icons?|inner|items?|labels?|left|links?|lists?|main|"
    r"outer|panels?|right|rows?|sections?|slots?|tags?|text|titles?|tops?|units?|widgets?|wrap(per)?s?"
)
#: Elements that hold the text of a page; a word within a longer name does not tell against them.
HOLDERS = frozenset(["article", "main", "section"])
# An opening paragraph or item ends one that is still open.
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}


def marked(names: str, whole: bool = False) -> bool:
    """Whether a class, id or role says that an element is no main text: by a name as a whole,
    or by a word of it that ends it or is followed by words for places alone."""
    for name in names.split():
        if MARKED.fullmatch(name):
            return True
        parts = [] if whole else [p for p in re.split(r"[-_]+", name) if p]
        for at, part in enumerate(parts):
            if part in BESIDE:
                break
            if MARKED.fullmatch(part) and all(MARKED.fullmatch(p) or PLACES.fullmatch(p) for p in parts[at + 1 :]):
                return True
    return False


class Node:
    __slots__ = ("tag", "names", "children", "inside", "dropped", "under")

    def __init__(self, tag: str, names: str, inside: bool, dropped: bool, under: bool = False):
        self.tag = tag
        self.names = names
        self.children: list[Node | str] = []
        self.inside = inside  # in an article
        self.dropped = dropped  # no main text by its own tag or names
        self.under = under  # in an element that is no main text


class TreeReader(HTMLParser):
    """Reads a page into nodes, kept in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("", "", False, False)]
        self.open = [self.nodes[0]]

    def _close_to(self, place: int) -> None:
        del self.open[place:]

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br" or tag in BLOCK:
                self.open[-1].children.append("\n" if tag == "br" else Node(tag, "", False, False))
            return
        if tag in BLOCK and tag != "html" and tag != "body":
            self._end_open(CLOSED_BY_BLOCK, ("table", "button"))
        if tag in SIBLINGS:
            self._end_open(SIBLINGS[tag], STOPS[tag])
        found = {k: v or "" for k, v in attrs if k in ("class", "id", "role")}
        names = " ".join(found.values()).lower()
        parent = self.open[-1]
        dropped = tag in NO_TEXT or marked(names, tag in HOLDERS) or any(k == "hidden" for k, _ in attrs)
        if tag in ("html", "body", "main"):
            dropped = False
        if tag == "header" and not parent.inside:
            dropped = True
        node = Node(
            tag, names, parent.inside or tag in ("article", "main"), dropped, parent.under or parent.dropped
        )
        parent.children.append(node)
        self.nodes.append(node)
        self.open.append(node)

    def _end_open(self, tags, stops) -> None:
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag in tags:
                self._close_to(place)
                return
            if self.open[place].tag in stops or self.open[place].tag in BLOCK:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and len(self.open) > 1 and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag == tag:
                self._close_to(place)
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def read_page(html: str) -> list[Node]:
    """The nodes of a page; the first one holds all others.

    A tag that the page breaks off in is no text.
    """
    last = html.rfind("<")
    if last > html.rfind(">") and re.match(r"[/!?A-Za-z]", html[last + 1 : last + 2]):
        html = html[:last]
    reader = TreeReader()
    reader.feed(html)
    reader.close()
    return reader.nodes


def subtree_hashes(nodes: list[Node]) -> dict[int, int]:
    """Signed hashes of subtrees that hold text, by node number: those outside the article,
    and the boxes in it."""
    hashes: dict[int, tuple[int, bool]] = {}
    out = {}
    for number in range(len(nodes) - 1, 0, -1):
        node = nodes[number]
        parts, filled = [node.tag, node.names], False
        for child in node.children:
            if isinstance(child, str):
                words = " ".join(child.split())
                parts.append(words)
                filled |= bool(words)
            else:
                value, some = hashes.get(id(child), (0, False))
                parts.append(str(value))
                filled |= some
        value = xxhash.xxh3_64_intdigest("\x1f".join(parts))
        hashes[id(node)] = value, filled
        if node.inside and (
            node.tag in ("article", "main") or node.tag not in BLOCK or node.tag in PROSE and not node.names
        ):
            continue
        if filled and node.tag not in ("html", "body", "head", "title", "script", "style"):
            out[number] = value - (1 << 64) if value >> 63 else value
    return out


def _roots(nodes: list[Node], deleted: set[int]) -> list[Node]:
    """The articles of a page, or its ``main`` elements, or the page itself.

    Articles in a ``main`` element are teasers if less than half of the text that is left of it
    stands in them; then it is read as a whole.
    """
    def of(tag: str) -> list[Node]:
        found = [n for n in nodes if n.tag == tag and not n.dropped]
        return [n for n in found if not n.under] or found

    articles, mains = of("article"), of("main")
    if articles and mains:
        whole = len("".join(_blocks(mains, deleted)))
        within = {id(n) for main in mains for n in _below(main)}
        inner = [n for n in articles if id(n) in within]
        if 2 * len("".join(_blocks(inner, deleted))) < whole:
            return mains
    return articles or mains or nodes[:1]


def _below(root: Node) -> list[Node]:
    found, at = [root], 0
    while at < len(found):
        found += [c for c in found[at].children if not isinstance(c, str)]
        at += 1
    return found


def main_text(nodes: list[Node], template: set[int]) -> str:
    """The blocks of the main text; ``template``: numbers of nodes to delete."""
    deleted = {id(nodes[n]) for n in template}
    return "\n".join(_blocks(_roots(nodes, deleted), deleted))


def _blocks(roots: list[Node], deleted: set[int]) -> list[str]:
    blocks: list[list[str]] = [[]]
    seen: set[int] = set()
    for root in roots:
        if id(root) in seen:
            continue
        blocks.append([])
        path = [iter((root,))]
        ends: list[bool] = [False]
        while path:
            child = next(path[-1], None)
            if child is None:
                path.pop()
                if ends.pop():
                    blocks.append([])
            elif isinstance(child, str):
                blocks[-1].append(child)
            elif child is root or not (child.dropped or id(child) in deleted):
                seen.add(id(child))
                block = child.tag in BLOCK
                if block:
                    blocks.append([])
                path.append(iter(child.children))
                ends.append(block)
            elif child.tag in BLOCK:
                blocks.append([])
    lines = (" ".join("".join(b).split()) for b in blocks)
    return [line for line in lines if line]


def text_without(nodes: list[Node], template: set[int]) -> str:
    """The main text without the template, but with all of an article of which that is more
    than half."""
    rest = main_text(nodes, template)
    boxes = {n for n in template if nodes[n].inside}
    if boxes:
        whole = main_text(nodes, template - boxes)
        if 2 * len(rest) < len(whole):
            return whole
    return rest


def host_of(url: str) -> Column:
    """Host of an address, in lower case and without user and port; empty where null."""
    authority = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def _decoded(batch, column: str) -> list[str]:
    return [t.decode("utf-8", "replace") for t in texts(batch, column)]


def _salted(host: str, value: int) -> int:
    """A subtree's hash on its host, signed."""
    value = xxhash.xxh3_64_intdigest(f"{value}\x1f{host}")
    return value - (1 << 64) if value >> 63 else value


def _hashes(batches):
    for batch in slices(batches, "_html"):
        rows, hashes, bodies = [], [], []
        for row, (html, host) in enumerate(zip(_decoded(batch, "_html"), batch.column("_host").to_pylist())):
            nodes = read_page(html)
            found = {_salted(host, h) for h in subtree_hashes(nodes).values()}
            body = xxhash.xxh3_64_intdigest(main_text(nodes, set()))
            rows += [row] * len(found)
            hashes += found
            bodies += [body - (1 << 64) if body >> 63 else body] * len(found)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_page").take(at), pa.array(hashes, pa.int64()), pa.array(bodies, pa.int64())],
            ["_page", "_hash", "_body"],
        )


def _extract(carried: list[str], shared=None):
    """Texts without the template: ``shared`` are its sorted hashes, else each page has its own."""

    def run(batches):
        every = set(shared.value.tolist()) if shared is not None else None
        for batch in slices(batches, "_html"):
            out = []
            own = batch.column("_template").to_pylist() if shared is None else [every] * batch.num_rows
            for html, host, known in zip(_decoded(batch, "_html"), batch.column("_host").to_pylist(), own):
                nodes = read_page(html)
                known = set(known or ()) if shared is None else known
                numbers = {n for n, h in subtree_hashes(nodes).items() if _salted(host, h) in known} if known else set()
                out.append(text_without(nodes, numbers))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried] + [pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                [*carried, "text", "n_chars"],
            )

    return run


def template_hashes(found: DataFrame, min_pages: int) -> DataFrame:
    """``_hash`` of subtrees in many different page bodies of their host."""
    different = found.groupBy("_hash", "_body").agg(F.lit(1).alias("_one"))
    counted = different.groupBy("_hash").agg(F.count(F.lit(1)).alias("_in"))
    return counted.filter(F.col("_in") >= min_pages).select("_hash")


def extract_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    plain = pages.select(
        F.col(page_id).alias("_id"), F.col(url).alias("_url"), host_of(url).alias("_host"),
        row_key(pages, page_id, html)[0].alias("_page"), F.col(html).cast("binary").alias("_html"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in plain.schema}
    found = pin(plain.select("_page", "_host", "_html").mapInArrow(
        _hashes, f"_page {kinds['_page']}, _hash long, _body long"
    ))
    template = pin(template_hashes(found, min_pages))
    names = {"_id": page_id, "_url": url}
    result = f"_id {kinds['_id']}, _url {kinds['_url']}, text string, n_chars long"
    if template.count() <= BROADCAST_HASHES:
        # so many numbers; no page crosses the network
        hashes = np.array([r["_hash"] for r in template.collect()], np.int64)
        shared = pages.sparkSession.sparkContext.broadcast(hashes)
        read = plain.select("_id", "_url", "_host", "_html")
        return read.mapInArrow(_extract(["_id", "_url"], shared), result).withColumnsRenamed(names)
    deleted = found.join(template, "_hash").groupBy("_page").agg(F.collect_set("_hash").alias("_template"))
    whole = plain.select("_id", "_url", "_host", "_page", "_html").join(deleted, "_page", "left")
    return whole.select("_id", "_url", "_host", "_html", "_template").mapInArrow(
        _extract(["_id", "_url"]), result
    ).withColumnsRenamed(names)
