"""Main text of web pages by scoring their element tree.

Method: a page becomes a tree of block elements; inline markup leaves only its
text and the share of it inside links.  Elements that are never article text
(scripts, forms, menus, page headers and footers, sidebars, notices, adverts,
reader comments; by tag, role, or a word of class or id) are left out.  Each
stretch of text passes points, one plus its commas plus its length in
hundreds, whole to the container around it and by a half, a quarter, ... to the
ones further out.  A container's score is its points times the share of its
text outside links; the best one is kept, widened to the article or main
element around it, with those siblings that score a fifth of it or hold text of
their own outside links.  All text of what is kept is returned: blocks in page
order, a line each.

Character references are decoded as HTML5 does; white space (Unicode's, and
line breaks of ``br``) inside a block becomes one space.

Defined results: null or empty html, and pages whose text lies only in left-out
elements, give the empty text; a page without any block is one block; unclosed
elements end with the element around them, unclosed comments and scripts with
the page; a page of any length is read whole; repeated rows are extracted
alike; an empty table gives an empty result; extra columns pass through."""

from __future__ import annotations

import html as _html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm.registry import register
from stayline.sources.tables import table

#: Fixed names of HTML.  Text of RAW elements is no markup and no article text.
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements within a line whose content is no text of it, left out up to their end tag.
EMBEDDED = frozenset("button svg math object video audio canvas map datalist".split())
#: Elements that a block of text ends at; all others are inline.
BLOCKS = frozenset("""html head body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead
 tbody tfoot tr td th blockquote pre figure figcaption address hgroup details summary nav aside header footer form fieldset
 legend dialog menu search center hr""".split())
LEFT_OUT = frozenset("head nav aside footer form fieldset dialog menu search".split())
ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar
 tablist""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of the same list, up to the nearest of the outer ones.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
            "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
            "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})}
#: Words in class or id of what is no article text; words of comments count even beside a word of content.
NO_TEXT = frozenset("""nav navbar navigation menu menubar sidebar aside footer header masthead topbar banner ad ads advert
 adverts advertisement advertising adslot adbox sponsor sponsored promo promotion cookie cookies consent notice notices alert popup
 modal overlay newsletter subscribe subscription signup login share sharing social related recommended breadcrumb breadcrumbs
 pagination pager widget toolbar skip search""".split())
COMMENTS = frozenset("comment comments disqus respond replies reply".split())
CONTENT = frozenset("article content main post entry story body text".split())
#: Words before another one that then says something about the page's layout only.
LAYOUT = frozenset("has with no without".split())

_TAG = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>|!--(?:>|->|(.*?)(?:--!?>|\Z))|[!?/][^>]*>)""",
                  re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NAMED = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b", re.I)
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_COMMA = re.compile("[,،、，﹐]")
#: Elements that can be the best container; others pass their points on whole.
CONTAINERS = frozenset("#root html body main article section div".split())
SIBLING_SHARE = 0.2
LINKS_AT_MOST = 0.25
LINKS_ONLY = 0.9


class Node:
    """A block element: its blocks of text and child elements in order."""
    __slots__ = ("tag", "parent", "parts", "points", "out", "chars", "linked", "links")

    def __init__(self, tag: str, parent: Node | None, out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.parts: list[Node | str] = []
        self.points, self.chars, self.linked, self.links = 0.0, 0, 0, 0

    def outer(self):
        n = self.parent
        while n is not None:
            yield n
            n = n.parent


def _named_out(tag: str, attributes: str) -> bool:
    """Whether attributes say that an element is no article text."""
    if not _NAMED.search(attributes):
        return False
    found = {m[1].lower(): _html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if tag in ("html", "body"):
        return False
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return True
    if set(found.get("role", "").lower().split()) & ROLES:
        return True
    words = [_PART.findall(_CAMEL.sub("-", w).lower()) for w in f"{found.get('class', '')} {found.get('id', '')}".split()]
    words = [w for w in words if w and not LAYOUT & set(w[:-1])]
    if any(COMMENTS & set(w) for w in words):
        return tag != "article" or not any(w[0] in ("post", "entry", "article") for w in words)
    if tag in ("article", "main") or any(w[0] in CONTENT and not NO_TEXT & set(w) for w in words):
        return False
    return any(NO_TEXT & set(w) for w in words)


def parse(page: str) -> Node:
    """The tree of the page's block elements."""
    root = node = Node("#root", None, False)
    text: list[str] = []        # of the open block
    links = linked = chars = 0  # open links; characters in links and in all of the open block
    a_open = False
    off: list[str] = []         # open inline elements that are left out, with what is inside
    opened: Counter = Counter()  # open elements by name
    endless: set[str] = set()    # names without a further end tag
    at, end, last = 0, len(page), page.rfind(">")

    def say(raw: str):
        nonlocal linked, chars
        if raw and not off:
            s = _html.unescape(raw) if "&" in raw else raw
            text.append(s)
            if a_open:
                linked += len(s.strip())

    def close_block():
        nonlocal text, linked, links
        if text:
            s = " ".join("".join(text).split())
            if s:
                node.parts.append(s)
                node.chars += len(s)
                node.linked += min(linked, len(s))
            text, linked = [], 0
        node.links += links
        links = 0

    def close_to(n: Node):
        nonlocal node, a_open
        close_block()
        while node is not n:
            opened[node.tag] -= 1
            node = node.parent
        a_open = False

    def leave(names, stop) -> None:
        """End the open elements ``names`` within the nearest of ``stop``."""
        n, to = node, None
        while any(opened[t] for t in names) and n.parent is not None and n.tag not in stop:
            if n.tag in names:
                to = n.parent
            n = n.parent
        if to is not None:
            close_to(to)

    while at < end:
        lt = page.find("<", at)
        if lt < 0 or lt > last and not page.startswith("<!--", lt):
            say(page[at:])
            break
        say(page[at:lt])
        m = _TAG.match(page, lt)
        if m is None:
            say("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if not closing and (tag in RAW or tag in EMBEDDED):
            if tag not in endless and not (tag in EMBEDDED and m[3].endswith("/")):
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if stop:
                    at = stop.end()
                else:
                    endless.add(tag)
            if tag in RAW and tag in endless:
                at = end
        elif tag == "br":
            say(" ")
        elif tag in VOID and tag != "hr":
            continue
        elif tag not in BLOCKS:
            if tag == "a" and not off:
                a_open = not closing
                links += not closing
            if off:
                if closing and tag in off:
                    del off[len(off) - 1 - off[::-1].index(tag):]
                elif not closing and tag == off[0] and not m[3].endswith("/"):
                    off.append(tag)
            elif not closing and not m[3].endswith("/") and _named_out(tag, m[3]):
                off.append(tag)
        elif closing:
            off.clear()
            if node.tag != tag:
                names = HEADINGS if tag in HEADINGS else {tag}
                if any(opened[t] for t in names):
                    close_to(next(x for x in (node, *node.outer()) if x.tag in names).parent)
                else:
                    close_block()
            else:
                close_to(node.parent)
        else:
            off.clear()
            close_block()
            if node.tag == "p" or tag in HEADINGS and node.tag in HEADINGS:  # no block stands in a paragraph
                close_to(node.parent)
            if tag in SIBLINGS:
                leave(*SIBLINGS[tag])
            if tag != "hr":
                out = node.out or tag in LEFT_OUT or (
                    tag == "header" and not opened["article"] and not opened["main"])
                child = Node(tag, node, out or _named_out(tag, m[3]))
                node.parts.append(child)
                node = child
                opened[tag] += 1
    close_block()
    return root


def _score(root: Node) -> list[Node]:
    """Pass points outwards and add up characters; the elements that text reached."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [x for x in n.parts if isinstance(x, Node) and not x.out]
    for n in order:
        own = [x for x in n.parts if isinstance(x, str)]
        if own:
            points = sum(1 + len(_COMMA.findall(s)) + len(s) / 100 for s in own)
            points *= 1 - n.linked / max(1, sum(map(len, own)))
            n.points += points
    for n in reversed(order):
        if n.parent is not None:
            n.parent.points += n.points / 2 if n.tag in CONTAINERS else n.points
            n.parent.chars += n.chars
            n.parent.linked += n.linked
            n.parent.links += n.links
    return [n for n in order if n.chars]


def _density(n: Node) -> float:
    return n.linked / n.chars if n.chars else 0.0


def _kept(root: Node) -> list[Node]:
    nodes = _score(root)
    if not nodes:
        return []

    def score(n):
        return n.points * (1 - _density(n))
    best = max((n for n in nodes if n.tag in CONTAINERS), key=score)  # the first, thus outermost, of equal ones
    for name in ("article", "main"):
        around = [n for n in (best, *best.outer()) if n.tag == name]
        if around:
            best = around[-1]
            break
    if best.parent is None:
        return [best]
    least, whole = SIBLING_SHARE * score(best), best.tag in ("article", "main")

    def goes(n):
        if n is best:
            return True
        if n.out or not n.chars or _density(n) > LINKS_AT_MOST:
            return False
        return n.tag == best.tag and score(n) >= least if whole else True
    return [n for n in best.parent.parts if isinstance(n, Node) and goes(n)] or [best]


def _links_only(n: Node) -> bool:
    """A list or box of three or more links and hardly anything else is a menu."""
    return n.links >= 3 and n.tag in ("ul", "ol", "div", "section", "dl", "table") and _density(n) >= LINKS_ONLY


def _text(kept: list[Node]) -> str:
    lines, stack = [], list(reversed(kept))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            lines.append(x)
        elif not x.out and not _links_only(x):
            parts = x.parts
            if x.tag == "header":  # inside an article: its headings
                parts = [p for p in parts if isinstance(p, Node) and p.tag in HEADINGS | {"hgroup", "div"}]
            stack += reversed(parts)
    return "\n".join(lines)


def main_text(page: str | None) -> str:
    """The main text of one page."""
    return _text(_kept(parse(page))) if page else ""


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without column ``html``, with ``text``; a column of that name is replaced."""
    schema = T.StructType([f for f in pages.schema.fields if f.name not in (html, text)]).add(text, "string")

    def run(batches):
        for b in batches:
            keep = [n for n in b.schema.names if n not in (html, text)]
            found = pa.array((main_text(x.as_py()) for x in b.column(html)), pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], found], [*keep, text])
    return pages.mapInArrow(run, schema)


@register("op11_html_text")
def op11_html_text(spark, sf_dir: str) -> DataFrame:
    d = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return d.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
