"""Pages as trees of blocks, and the features of a block.

Inline markup belongs to the block around it; only elements that begin a block, and containers, are
nodes. Every node keeps its own text (the text not inside a child node) in pieces, as children may
stand in between.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

# How HTML nests. Without an end tag, RAW reaches to the end of the page, as HTML reads
# it; HELD then holds nothing.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes"}
HELD = {"noscript", "template", "svg", "annotation", "annotation-xml", "select", "head", "datalist", "audio", "video", "canvas"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = HEADINGS | {
    "html", "body", "main", "article", "section", "div", "p", "ul", "ol", "menu", "li", "dl", "dt", "dd", "table",
    "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "nav",
    "header", "footer", "aside", "form", "fieldset", "legend", "details", "summary", "address", "hgroup", "center",
    "dialog", "search", "button", "label", "option",
}
BREAKS = {"br", "hr", "img", "wbr"}
KEEPS_PARAGRAPH = {"html", "body", "li", "dt", "dd", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "button", "label", "legend", "option"}
# An element that begins closes the open ones named here, up to the first that holds it.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, set()),
}
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s>]*))|([^\s=/\"'>]+)")
NAMED = {"class", "id", "role", "aria-label", "data-main", "hidden", "aria-hidden", "itemprop"}

# Words in class, id or role by which pages name their parts.
PARTS = {
    "main": ["article", "content", "post", "entry", "story", "main", "text", "body", "articlebody", "prose"],
    "menu": ["nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "toc", "topbar", "toolbar", "tabs", "pagination", "pager", "skip"],
    "header": ["header", "masthead", "banner", "logo", "branding", "hero", "top"],
    "footer": ["footer", "foot", "copyright", "legal", "colophon", "bottom", "contentinfo", "credits"],
    "side": ["sidebar", "side", "aside", "related", "recommend", "recommended", "widget", "widgets", "trending", "popular", "more", "rail", "complementary", "latest", "teaser", "tags", "archive"],
    "advert": ["ad", "ads", "advert", "advertisement", "adbox", "sponsor", "sponsored", "promo", "promoted", "promotion", "banner-ad", "dfp", "offer"],
    "notice": ["cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "paywall", "message", "privacy", "disclaimer", "warning", "toast"],
    "form": ["form", "search", "login", "signup", "signin", "register", "contact", "feedback", "poll"],
    "comments": ["comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion", "responses", "reviews", "forum", "thread"],
    "share": ["share", "sharing", "social", "follow", "like", "print", "byline", "meta", "author", "bio"],
}
PART_OF = {word: part for part, words in PARTS.items() for word in words}
LONG_WORDS = [w for w in PART_OF if len(w) >= 6]
TAGS = ["html", "body", "main", "article", "section", "div", "p", "heading", "list", "item", "table", "cell", "quote", "pre", "figure", "nav", "header", "footer", "aside", "form", "details", "address", "other"]
TAG_OF = (
    {h: "heading" for h in HEADINGS}
    | {"ul": "list", "ol": "list", "menu": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item"}
    | {t: "table" for t in ("table", "thead", "tbody", "tfoot", "tr", "caption")}
    | {"td": "cell", "th": "cell", "blockquote": "quote", "figcaption": "figure", "fieldset": "form", "button": "form", "label": "form", "legend": "form", "option": "form", "search": "form", "summary": "details", "dialog": "aside", "center": "div", "hgroup": "heading"}
)
LENGTHS, LINKS = [0, 25, 80, 200], [0.0, 0.3, 0.7]
FEATURES = (
    ["bias"]
    + [f"tag {t}" for t in TAGS]
    + [f"part {p}" for p in PARTS]
    + [f"length {i}" for i in range(len(LENGTHS) + 1)]
    + [f"links {i}" for i in range(len(LINKS) + 1)]
    + ["sentence", "rights", "hidden"]
)
NUMBER = {name: i for i, name in enumerate(FEATURES)}
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORDS = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    named: dict[str, str]
    text: list[str] = field(default_factory=list)
    linked: int = 0


def named_attributes(raw: str) -> dict[str, str]:
    if "=" not in raw and "hidden" not in raw:
        return {}
    found = {}
    for name, double, single, bare, alone in ATTRIBUTE.findall(raw):
        key = (name or alone).lower()
        if key in NAMED:
            found.setdefault(key, html.unescape(double or single or bare))
    return found


def read_page(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The nodes of a page, parents before children, and its blocks in page order as (node, text).

    Tags left open are closed as HTML implies. Raw and held elements, comments and declarations hold no
    text; formulas, listings and what stands in for an object are text like any other.
    A block is the text of one node between two of its child nodes.
    """
    nodes = [Node("html", -1, {})]
    blocks: list[tuple[int, str]] = []
    stack = [0]
    open_at: dict[str, list[int]] = {}  # rising places on the stack of each tag's open elements
    run: list[str] = []
    links = 0
    ends: dict[str, list[tuple[int, int]]] = {}
    pairs: dict[str, dict[int, int]] = {}

    def flush() -> None:
        if run:
            # A reference may be cut in two by markup only; the text between two tags is decoded whole.
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                owner = stack[-1]
                if nodes[owner].tag in ("html", "body"):  # loose text is a paragraph without a tag
                    owner = len(nodes)
                    nodes.append(Node("p", stack[-1], {}))
                nodes[owner].text.append(text)
                blocks.append((owner, text))

    def open_tag(tag: str) -> int | None:
        places = open_at.get(tag)
        return places[-1] if places else None

    def push(tag: str, raw: str) -> None:
        nodes.append(Node(tag, stack[-1], named_attributes(raw)))
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes) - 1)

    def close(depth: int) -> None:
        flush()
        for number in stack[depth:]:
            open_at[nodes[number].tag].pop()
        del stack[depth:]

    def finish(tag: str, begin: int) -> tuple[int, int]:
        """The end tag of a raw element, looking for each kind's end tags once only."""
        if tag not in ends:
            ends[tag] = [m.span() for m in re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*+(?:>|\\Z)", re.I).finditer(page)]
        place = bisect_left(ends[tag], (begin,))
        return ends[tag][place] if place < len(ends[tag]) else (end, end)

    def finish_held(tag: str, start: int) -> int | None:
        """Where an element ends that may hold others of its kind; None if it is not closed."""
        if tag not in pairs:
            pairs[tag], begun = {}, []
            for m in re.compile(f"<(/?){re.escape(tag)}(?=[\\s/>])[^>]*+(?:>|\\Z)", re.I).finditer(page):
                if not m[1] and not m[0].endswith("/>"):
                    begun.append(m.start())
                elif m[1] and begun:
                    pairs[tag][begun.pop()] = m.end()
        return pairs[tag].get(start)

    at, end = 0, len(page)
    while at < end:
        mark = TOKEN.search(page, at)
        text = page[at : mark.start() if mark else end]
        if text:
            run.append(html.unescape(text) if "&" in text else text)
            if links:
                nodes[stack[-1]].linked += len(text)
        if not mark:
            break
        at = mark.end()
        tag = (mark[2] or "").lower()
        if not tag:
            continue
        closing = bool(mark[1])
        if tag in RAW:
            if not closing and not mark[3].endswith("/"):
                at = finish(tag, at)[1]
            run.append(" ")
        elif tag in HELD:
            if not closing and not mark[3].endswith("/"):
                at = finish_held(tag, mark.start()) or at
            run.append(" ")
        elif tag == "xmp":  # its text is shown as it stands, marks included
            if not closing:
                if (place := open_tag("p")) is not None:
                    close(place)
                flush()
                push("pre", mark[3])
                until, after = finish(tag, at)
                run.append(page[at:until])
                at = after
                close(len(stack) - 1)
        elif tag in BREAKS:
            if tag == "hr":
                flush()
            else:
                run.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCKS:
            if closing:
                place = open_tag(tag)
                if place is not None:
                    close(place)
                else:
                    flush()
                continue
            if tag in ("html", "body") and (tag == "html" or open_tag("body")):
                continue
            if tag not in KEEPS_PARAGRAPH and (place := open_tag("p")) is not None:
                close(place)
            if tag in CLOSED_BY:
                closed, holders = CLOSED_BY[tag]
                holder = max((open_tag(t) or 0 for t in holders), default=0)
                inside = [p[k] for t in closed if (p := open_at.get(t)) and (k := bisect_right(p, holder)) < len(p)]
                if inside:
                    close(min(inside))
            flush()
            push(tag, mark[3])
    flush()
    return nodes, blocks


def parts_named(named: dict[str, str]) -> set[str]:
    found = set()
    for key in ("class", "id", "role", "itemprop"):
        value = named.get(key)
        if value:
            for word in WORDS.findall(CAMEL.sub(" ", value).lower()):
                if word in PART_OF:
                    found.add(PART_OF[word])
                else:
                    found |= {PART_OF[w] for w in LONG_WORDS if w in word}
    return found


def features(node: Node) -> list[int]:
    """The numbers of the features that hold for a node."""
    text = " ".join(node.text)
    names = ["bias", f"tag {TAG_OF.get(node.tag, node.tag if node.tag in TAGS else 'other')}"]
    names += [f"part {p}" for p in sorted(parts_named(node.named))]
    names.append(f"length {sum(len(text) > x for x in LENGTHS)}")
    names.append(f"links {sum(node.linked / max(1, len(text)) > x for x in LINKS)}")
    if text and text[-1] in ".!?…\"'”»":
        names.append("sentence")
    if "©" in text or "copyright" in text[:200].lower():
        names.append("rights")
    if "hidden" in node.named or node.named.get("aria-hidden") == "true":
        names.append("hidden")
    return [NUMBER[n] for n in names]
