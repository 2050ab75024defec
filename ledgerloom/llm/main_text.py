"""Main text of web pages by tree scoring.

A page is read once into a tree of open elements.  Every text block passes points for its length
and commas to its ancestors, whole to the parent and less further up, discounted by the share of
link text.  The container with the most points wins; siblings of enough points, or that are plain
paragraphs of prose, are kept beside it.  Menus, headers, footers, sidebars, adverts, forms, reader
comments, scripts and styles are cut while reading, by element or by the words in class, id and
role.  Elements whose names only hint at that ("widget", "hidden", "sidebar-right") are judged when
the page has been read, by their links and their share of its text; articles never go by such names.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: element names and the words of class, id and role attributes
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template"}
CUT = {"nav", "footer", "aside", "form", "button", "select", "option", "input", "label", "fieldset", "dialog", "menu", "head", "svg", "math", "canvas", "audio", "video", "object", "embed", "map", "datalist", "output", "progress", "meter", "legend"} | RAW
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: elements that the start of another one ends, and those it doesn't reach across
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: words of elements that may be long and hold prose but are never the main text
CUT_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "adsense", "sidebar", "aside", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "foot", "masthead",
    "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "pagination", "pager", "outbrain", "taboola",
}
#: words that as often name a part of the layout as something beside the main text
SOFT_WORDS = {
    "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login",
    "share", "sharing", "social", "related", "recommended", "widget", "toolbar", "skip", "hidden", "alert", "disclaimer", "copyright", "topbar", "search",
}
#: a doubtful element goes if this share of it is links, or its words stand on less than this share of the page's text; else it loses points
LINKED_SHARE, SMALL_SHARE, DOUBTFUL_POINTS = 0.4, 0.3, 0.75
#: the same for a name made of a cut word and others ("sidebar-right"), unless it holds an article or heading
LARGE_SHARE = 0.6
IN_HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noscript", "script", "style", "template", "title"}
CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
#: a name with one of these tells what stands beside the element: "has-sidebar"
BESIDE_WORDS = {"has", "with", "without", "no", "js"}

_TAG = re.compile(r"<(?:!--(.*?)(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|([!?][^>]*)>)", re.S)
_LOOSE = re.compile(r"</?[a-zA-Z!?][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("name", "parent", "points", "chars", "linked", "cut", "order", "words", "hard", "doubt", "size", "links", "holds", "gone")

    def __init__(self, name: str, parent: Node | None, cut: bool, order: int, words: tuple[set, bool] | None = None):
        self.name, self.parent, self.cut, self.order = name, parent, cut, order
        self.points, self.chars, self.linked = 0.0, 0, 0
        # doubtful elements: their words (and are these of the cut ones), text and linked text, and the nearest one around
        self.words, self.hard = words if words else (None, False)
        self.doubt = self if words else parent and parent.doubt
        self.size, self.links, self.holds, self.gone = 0, 0, False, False


def judged(name: str, attributes: str, parent: Node) -> tuple[bool, tuple[set, bool] | None]:
    """Does an element never hold main text?  If that is in doubt: the words that say so, and if they are cut words."""
    if name in CUT:
        return True, None
    if name == "header":  # a page header, unless it opens the article itself
        up = parent
        while up is not None:
            if up.name in ("article", "main"):
                return False, None
            up = up.parent
        return True, None
    if not attributes.strip() or name in ("body", "html", "main"):
        return False, None
    soft, hard = set(), set()
    for m in _ATTR.finditer(attributes):
        key = m.group(1).lower()
        value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            return True, None
        if key == "role" and value.strip() in CUT_ROLES:
            return True, None
        if key in ("class", "id"):
            for one in value.split():
                words = _WORD.findall(one)
                if not words or BESIDE_WORDS.intersection(words):
                    continue
                if len(words) == 1 and words[0] in CUT_WORDS:
                    return True, None
                soft |= {words[0], words[-1]} & SOFT_WORDS
                hard |= {words[0], words[-1]} & CUT_WORDS
    return False, (hard or soft, bool(hard)) if soft or hard else None


class Page:
    """Blocks of text, each with the element it stands in, and the elements' points."""

    def __init__(self, source: str):
        self.root = self.at = Node("", None, False, 0)
        self.n_nodes, self.blocks = 1, []  # (container, texts with their linked characters and doubtful element)
        self.text, self.links, self.doubtful = [], 0, []
        self.where = self.root
        self.read(source)
        self.flush()
        self.settle()

    def flush(self) -> None:
        """End the current block."""
        if self.text:
            self.blocks.append((self.where, self.text))
        self.text = []

    def add(self, raw: str, decode: bool = True) -> None:
        if self.at.name == "head" and not raw.isspace():
            self.end_head()
        if self.at.cut or not raw:
            return
        text = entities.unescape(raw) if decode and "&" in raw else raw
        if not self.text:
            up = self.at
            while up.parent is not None and up.name not in BLOCK:
                up = up.parent
            self.where = up
        self.text.append((text, len(text.strip()) if self.links else 0, self.at.doubt))

    def end_head(self) -> None:
        while self.at.name == "head":
            self.leave(self.at)

    def settle(self) -> None:
        """Decide on the doubtful elements, and join the texts of each block that stay: (container, text, linked characters)."""
        if self.doubtful:
            self.decide()
        blocks, self.blocks = self.blocks, []
        for where, parts in blocks:
            kept = [x for x in parts if x[2] is None or not x[2].gone]
            text = _SPACE.sub(" ", "".join(x[0] for x in kept)).strip()
            if text:
                self.blocks.append((where, text, sum(x[1] for x in kept)))

    def decide(self) -> None:
        total = 0
        for _, parts in self.blocks:
            for text, linked, doubt in parts:
                n = len(text.strip())
                total += n
                if doubt is not None:
                    doubt.size += n
                    doubt.links += linked
        held: dict[str, int] = {}  # text in elements of each word, outermost ones
        for node in reversed(self.doubtful):
            around = node.parent.doubt
            if around is not None:
                around.size += node.size
                around.links += node.links
                around.holds |= node.holds
        for node in self.doubtful:
            around, fresh = node.parent.doubt, set(node.words)
            while around is not None and fresh:
                fresh -= around.words
                around = around.parent.doubt
            for word in fresh:
                held[word] = held.get(word, 0) + node.size

        def go(node: Node, small: bool) -> bool:
            if node.holds and (node.hard or node.size >= SMALL_SHARE * total):
                return False
            if node.links >= LINKED_SHARE * max(1, node.size):
                return True
            return small and min(held[w] for w in node.words) < (LARGE_SHARE if node.hard else SMALL_SHARE) * total

        for small in (True, False):  # where nothing would stay, only links and cut words decide
            for node in self.doubtful:
                around = node.parent.doubt
                node.gone = go(node, small or node.hard) or around is not None and around.gone
            if any(text.strip() and (doubt is None or not doubt.gone) for _, parts in self.blocks for text, _, doubt in parts):
                return

    def open(self, name: str, attributes: str) -> None:
        if name not in IN_HEAD:
            self.end_head()
        if name in VOID:
            if name == "hr":
                self.flush()
            elif name == "br":
                self.add(" ")
            return
        if name in CLOSES_P:
            self.close_upto({"p"}, {"table", "td", "th", "button", "caption", "object"})
        if name in IMPLIED:
            self.close_upto(*IMPLIED[name])
        if name in BLOCK:
            self.flush()
        if name == "a":
            self.close_upto({"a"}, BLOCK)
            self.links += 1
        cut, words = (True, None) if self.at.cut else judged(name, attributes, self.at)
        if name in ("article", "main", "h1") and not cut:
            if self.at.doubt is not None and not (words and words[1]):
                self.at.doubt.holds = True
            words = None
        self.at = Node(name, self.at, cut, self.n_nodes, words)
        self.n_nodes += 1
        if words:
            self.doubtful.append(self.at)

    def close_upto(self, names: set[str], stop: set[str]) -> None:
        """End the outermost open element of ``names`` that isn't beyond one of ``stop``."""
        up, found = self.at, None
        while up.parent is not None and up.name not in stop:
            if up.name in names:
                found = up
            up = up.parent
        if found is not None:
            self.leave(found)

    def close(self, name: str) -> None:
        if name == "p" and name not in self.open_names():
            self.flush()
            return
        if name == "br":
            self.add(" ")
            return
        up = self.at
        while up.parent is not None and up.name != name:
            if name not in BLOCK and up.name in BLOCK:
                return  # an inline end tag doesn't end blocks
            up = up.parent
        if up.parent is not None:
            self.leave(up)

    def open_names(self) -> Iterator[str]:
        up = self.at
        while up.parent is not None:
            yield up.name
            up = up.parent

    def leave(self, node: Node) -> None:
        while True:
            done, self.at = self.at, self.at.parent
            if done.name in BLOCK:
                self.flush()
            if done.name == "a":
                self.links -= 1
            if done is node:
                return

    def read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            to = source.find("<", at)
            if to < 0:
                self.add(source[at:])
                return
            if to > at:
                self.add(source[at:to])
            m = _TAG.match(source, to)
            if m is None:
                m2 = _LOOSE.match(source, to)
                if m2 is None:
                    self.add("<")
                    at = to + 1
                else:
                    at = m2.end()  # a tag that never ends or has an open quote
                continue
            at = m.end()
            name = m.group(3)
            if name is None:
                continue
            name = name.lower()
            if m.group(2):
                self.close(name)
                continue
            self.open(name, m.group(4) or "")
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else n
                self.close(name)


def points_of(text: str, linked: int) -> float:
    """Points of a block: one, its commas, and a point for 100 characters up to three, less its links."""
    density = min(1.0, linked / max(1, len(text)))
    return (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - density)


def main_blocks(source: str) -> list[str]:
    page = Page(source)
    inner: dict[int, Node] = {}
    for where, text, linked in page.blocks:
        points, up, share = points_of(text, linked), where, 1.0
        if where.name in ("p", "li", "dd", "dt", "td", "th", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption", "caption"):
            up = where.parent
        depth = 0
        while up is not None:
            up.points += points * share
            up.chars += len(text)
            up.linked += linked
            inner[up.order] = up
            depth += 1
            share = 0.5 if depth == 1 else share * 2 / 3
            up = up.parent
    if not page.blocks:
        return []

    def final(node: Node) -> float:
        bonus = 1.5 if node.name in ("article", "main") else 1.0
        if node.words:
            bonus *= DOUBTFUL_POINTS
        return node.points * bonus * (1 - min(1.0, node.linked / max(1, node.chars)))

    best = max(inner.values(), key=lambda v: (final(v), -v.order))
    up = best
    while up is not None:  # parts of one article belong to it
        if up.name in ("article", "main"):
            best = up
        up = up.parent
    least = max(10.0, final(best) / 5)
    beside = best.parent if best.name not in ("body", "html", "") else None

    def kept(where: Node, text: str, linked: int) -> bool:
        child, up = None, where
        while up is not None and up is not best and up is not beside:
            child, up = up, up.parent
        if up is best:
            return True
        if up is None or best.name in ("article", "main") and (child is None or child.name not in ("article", "main", "section")):
            return False
        if child is None:  # text of the parent itself
            return False
        if child.name == "p" or child.name in ("h1", "h2"):
            density = linked / max(1, len(text))
            return len(text) > 80 and density < 0.25 or len(text) <= 80 and density == 0 and text.rstrip()[-1:] in ".!?"
        return final(child) >= least

    return [text for where, text, linked in page.blocks if kept(where, text, linked)]


def main_text(source: str | None) -> str:
    """Blocks of the main text in page order, joined by one newline; empty if there are none."""
    return "\n".join(main_blocks(source or ""))


def extract(pages: DataFrame) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null and empty pages have empty text; text without markup is a block; tags that never end,
    open quotes, stray end tags and unclosed elements don't stop it; repeated rows give the same
    text; other columns don't matter; an empty table gives no rows.
    """

    def task(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(task, "page_id long, url string, text string, n_chars long")
