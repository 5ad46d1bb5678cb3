"""Main text of HTML pages by composite text density (Sun, Song and Liao, "DOM based content extraction via text density", 2011).

Every element gets its characters C, tags T, link characters LC and link tags LT, below it and in it; zero counts as 1
where it divides. Its density is C / T * log(C / LC * T / LT) to the base ln(C / (C - LC) * LC + LCb / Cb * C + e), with
LCb and Cb of the body: text with few tags is dense, text in links is not. An element's density sum adds up its
children's. Tags that mark up words (bold, spans) are part of their parent's text. The element with the largest sum is the content; the smallest density on its path to the body is the
threshold, and elements elsewhere that reach it give their own largest-sum element.

What is never main text leaves the page first. Elements whose tag or role says so (scripts, menus, forms, footers) leave it as it is read.
Elements with a noise name as a whole class or id leave it once densities are known: one that holds an article or main element with text stays, and so
does one whose name may be a layout's as well (``MAYBE``) if it holds the densest element and most of the page's text, where no article or main element
holds text elsewhere. A page of which nothing would be left keeps these, then all of its elements.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import with_fields

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form button select textarea input option label iframe object embed svg math canvas audio video map dialog menu".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
    "search section summary table tbody td tfoot th thead tr ul br".split()
)
#: Tags that mark up words: their text is their parent's, and they count as no tag, or a paragraph in bold would be thinner than a plain one.
INLINE = frozenset("abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCKS - frozenset("br td th tr tbody thead tfoot option html body legend summary".split()) | {"summary"}
#: Start tag to the open elements that it ends, up to the nearest element of the third group.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: An end tag does not close elements beyond these.
SCOPES = frozenset("table td th body html".split())
#: Names (of a class or id) of noise, alone or together, or with words of place: of layout's parts, which a page may give to what holds its text as well, and of others.
_MAYBE = r"sidebar|side-?bar|widget|aside|menu|nav|navbar|navigation|toolbar|masthead|topbar|header|footer|banner|notices?|alert|promo(?:tion)?"
_SURE = (
    r"ads?|adverts?|advertisement|advertising|adslot|adsense|sponsor(?:ed)?|outbrain|taboola|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|breadcrumbs?|pagination|pager|skip-?link|"
    r"comments?|commentlist|disqus|respond|replies|reply"
)
_WORD = rf"(?:{_MAYBE}|{_SURE})"
_PLACE = r"(?:site-?|page-?|(?:main|global|top|bottom|left|right|primary|secondary)[_-])"
_TAIL = r"(?:[_-]?(?:list|box|bar|area|container|wrapper|block|slot|unit|left|right|top|bottom|\d+))*"
_NOISE = re.compile(rf"{_PLACE}?{_WORD}(?:[_-]+{_WORD})*{_TAIL}", re.I)
_UNSURE = re.compile(rf"{_PLACE}?(?:{_MAYBE})(?:[_-]+(?:{_MAYBE}))*{_TAIL}", re.I)
SURE, MAYBE = 2, 1
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split())
_TEXT_HOLDERS = frozenset(("html", "body", "main", "article"))


class Node:
    __slots__ = ("chars", "density", "items", "link_chars", "link_tags", "noise", "parent", "sum", "tag", "tags")

    def __init__(self, tag: str, parent: Node | None, noise: int = 0):
        self.tag, self.parent, self.items, self.noise = tag, parent, [], noise


class TreeBuilder(HTMLParser):
    """A tree of what may be main text. Missing end tags are supplied; what tag or role make noise is skipped with all that it holds, what a name makes noise is marked."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("body", None)
        self.noise: list[str] = []

    def _is_noise(self, tag: str, attrs) -> bool:
        if tag in DROPPED:
            return True
        if tag == "header":
            at = self.at
            while at is not None and at.tag not in ("article", "main"):
                at = at.parent
            return at is None
        if tag in _TEXT_HOLDERS:
            return False
        for name, value in attrs:
            if name == "hidden" and (value or "").lower() != "until-found":
                return True
            if value and (name == "role" and value.lower() in _ROLES or name == "aria-hidden" and value.lower() == "true"):
                return True
            if value and name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        return False

    @staticmethod
    def _named(tag: str, attrs) -> int:
        """Whether a name makes the element noise: 0, MAYBE or SURE."""
        if tag in _TEXT_HOLDERS:
            return 0
        names = [x for name, value in attrs if name in ("class", "id") and value for x in value.split() if _NOISE.fullmatch(x)]
        return 0 if not names else MAYBE if all(map(_UNSURE.fullmatch, names)) else SURE

    def _open(self, tags, stops) -> Node | None:
        """The nearest open element of ``tags``, none beyond one of ``stops``."""
        at = self.at
        while at is not self.root and at.tag not in stops:
            if at.tag in tags:
                return at
            at = at.parent
        return None

    def handle_starttag(self, tag, attrs):
        if self.noise:
            # An article or main text inside of noise that was never ended is looked at again.
            if tag in ("article", "main") and self.noise[0] not in ("template", "noscript", "dialog"):
                self.noise.clear()
            else:
                if tag not in VOID:
                    self.noise.append(tag)
                return
        if tag in ("html", "body"):
            return
        if tag in ENDS_P and (p := self._open({"p"}, SCOPES)):
            self.at = p.parent
        if tag in ENDS:
            ended, stops = ENDS[tag]
            while node := self._open(ended, stops):
                self.at = node.parent
        if tag in VOID:
            self.at.items.append(" " if tag in BLOCKS else "")
        elif self._is_noise(tag, attrs):
            self.at.items.append(" " if tag in BLOCKS else "")  # what it leaves is the break
            self.noise.append(tag)
        elif tag not in INLINE or self._named(tag, attrs):
            node = Node(tag, self.at, self._named(tag, attrs))
            self.at.items.append(node)
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash ends void elements only

    def handle_endtag(self, tag):
        if self.noise:
            if tag in self.noise:
                while self.noise.pop() != tag:
                    pass
            elif tag in ("article", "main", "section", "div", "body", "td") and self._open({tag}, ()):
                self.noise.clear()  # what encloses the noise has ended
                self.handle_endtag(tag)
            return
        if tag == "br":
            self.at.items.append(" ")
            return
        node = self._open({tag}, SCOPES - {tag})
        if node:
            self.at = node.parent

    def handle_data(self, data):
        if not self.noise:
            self.at.items.append(data)


def parse(html: str) -> Node:
    """The page's tree with named noise in it."""
    cut = html.rfind("<")
    if cut > html.rfind(">") and re.match(r"<[A-Za-z/!?]", html[cut : cut + 2]):
        html = html[:cut]  # a tag that the page's end broke off
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _path(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def without_noise(root: Node) -> Node:
    """The tree without named noise; see the module's text for what stays."""
    nodes = measure(root)
    if not any(n.noise and n.chars for n in nodes):
        return root
    best = {id(n) for n in _path(max(nodes, key=lambda n: n.sum))}
    clean: dict[int, int] = {}  # characters outside of named noise below
    for n in reversed(nodes):
        clean[id(n)] = n.chars - sum(x.chars if x.noise else x.chars - clean[id(x)] for x in n.items if isinstance(x, Node))
    under: dict[int, bool] = {}
    for n in nodes:
        under[id(n)] = n.noise > 0 or n.parent is not None and under[id(n.parent)]
    marked = [n for n in nodes if n.tag in ("article", "main") and clean[id(n)]]
    free = any(not under[id(n)] for n in marked)
    holders: set[int] = set()
    for n in marked:
        for x in _path(n):
            if id(x) in holders:
                break
            holders.add(id(x))

    def stays(n: Node, level: int) -> bool:
        if not n.noise or id(n) in holders or level > n.noise:
            return True
        return n.noise == MAYBE and not free and id(n) in best and 2 * n.chars > root.chars

    for level in (0, SURE, SURE + 1):
        gone: dict[int, bool] = {}
        for n in nodes:
            gone[id(n)] = n.parent is not None and gone[id(n.parent)] or not stays(n, level)
        if any(isinstance(x, str) and x.strip() for n in nodes if not gone[id(n)] for x in n.items):
            break
    for n in nodes:
        if not gone[id(n)]:
            n.items = [" " if isinstance(x, Node) and gone[id(x)] else x for x in n.items]
    return root


def _ordered(root: Node) -> list[Node]:
    """Parents before children, without recursion: pages may nest deeply."""
    out = [root]
    for node in out:
        out += [x for x in node.items if isinstance(x, Node)]
    return out


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all elements."""
    nodes = _ordered(root)
    for n in reversed(nodes):
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        for x in n.items:
            if isinstance(x, str):
                n.chars += len("".join(x.split()))
            else:
                n.chars += x.chars
                n.tags += x.tags + 1
                n.link_chars += x.link_chars
                n.link_tags += x.link_tags + (x.tag == "a")
        if n.tag == "a":
            n.link_chars = n.chars
    body_chars, body_links = max(1, root.chars), root.link_chars
    for n in nodes:
        c, t, lc, lt = n.chars, max(1, n.tags), n.link_chars, n.link_tags
        if not c:
            n.density = 0.0
            continue
        base = math.log(c / max(1, c - lc) * lc + body_links / body_chars * c + math.e)
        ratio = c / max(1, lc) * t / max(1, lt)
        n.density = c / t * math.log(max(1.0, ratio)) / math.log(base) if base > 1 + 1e-9 else c / t * math.log(max(1.0, ratio))
    for n in nodes:
        n.sum = sum(x.density for x in n.items if isinstance(x, Node))
    return nodes


def content(root: Node) -> list[Node]:
    """The content elements, in no order; none inside another."""
    nodes = measure(root)
    best = max(nodes, key=lambda n: n.sum)
    if best.sum <= 0:  # text with no element around it
        return [root] if root.chars else []
    threshold, at = best.density, best
    while at is not None:
        threshold = min(threshold, at.density)
        at = at.parent
    top: dict[int, Node] = {}
    for n in reversed(nodes):
        found = n if n.sum > 0 or not any(isinstance(x, Node) for x in n.items) else None
        for x in n.items:
            if isinstance(x, Node) and (y := top.get(id(x))) is not None and (found is None or y.sum > found.sum):
                found = y
        top[id(n)] = found
    chosen, skip = {id(best): best}, set()
    above = set()
    at = best
    while at is not None:
        above.add(id(at))
        at = at.parent
    for n in nodes:
        if id(n) in skip or n.parent is not None and id(n.parent) in skip or id(n) == id(best):
            skip.add(id(n))
            continue
        if id(n) in above or n.density < threshold or not n.chars:
            continue
        # A dense element beside the content: of it, what has the largest sum.
        found = top[id(n)]
        if found is not None and found.chars:
            chosen[id(found)] = found
            skip.add(id(n))
    return list(chosen.values())


def text_of(root: Node, chosen: list[Node]) -> str:
    """The chosen elements' text in page order: white space is one space, a block's edge too."""
    marks, out = {id(n) for n in chosen}, []
    stack: list = [(root, False, False)]
    while stack:
        item, inside, leaving = stack.pop()
        if isinstance(item, str):
            if inside:
                out.append(item)
            continue
        inside = inside or id(item) in marks
        if item.tag in BLOCKS or id(item) in marks:
            out.append(" ")
        if not leaving:
            stack.append((item, inside, True))
            stack += [(x, inside, False) for x in reversed(item.items)]
    return " ".join("".join(out).split())


def main_text(html: str | None) -> str:
    """The main text of one page; empty for null, empty pages and pages without text."""
    if not html:
        return ""
    root = without_noise(parse(html))
    return text_of(root, content(root))


def extract(df: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``df`` with column ``out``, the main text of each whole page, in place of ``html_col``.

    Null and empty pages, and those without text, have an empty text. A worker holds one page's tree at a time, however long the page is, and a page nested deeply needs no deep stack. Of elements with
    equal density sums the first on the page counts. Rows (repeated ones, too) and other columns are kept as they are; a column named ``out`` is replaced; an empty table gives no rows.
    """
    rest = [c for c in df.columns if c not in (html_col, out)]
    rows = df.select(F.col(html_col).cast("string").alias("_html"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row"))
    kept = rows.schema["_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([main_text(h.as_py()) for h in part.column(0)], pa.string())], names=["_row", out])

    return rows.mapInArrow(run, with_fields(kept, f"`{out}` string")).select("_row.*", out)
