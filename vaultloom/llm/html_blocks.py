"""Leaf blocks of an HTML page with the features that a labeller sees.

A block is the text between two borders of block elements. Inline elements do not end
a block, <br> is white space in it, character references are decoded and each run of
white space is one space. Content that is no text (scripts, styles, titles, comments,
drawings, text fields) makes no block. Unclosed paragraphs, list items and cells end
where the next one begins; an end tag closes what is open inside its element; a tag,
comment or script that is never closed reaches to the end. One pass over the page.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape
from typing import NamedTuple

# Element names of HTML by their use.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p"
    " pre search section select summary table tbody td tfoot th thead tr ul".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TO_THE_END = frozenset("script style title textarea xmp iframe noembed noframes".split())
SKIPPED = TO_THE_END | frozenset("noscript template svg math canvas object audio video map".split())
CLOSES = {  # element: what it closes, and where the search for that ends
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"optgroup"}, {"select"})}
CONTAINERS = BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote ul ol dl figcaption figure tr tbody table".split())
ROLES = {
    "navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside", "main": "main",
    "article": "article", "search": "form", "form": "form", "dialog": "dialog", "alertdialog": "dialog",
    "alert": ".notice", "status": ".notice", "menu": "nav", "menubar": "nav", "feed": ".related"}

# Words of class and id attributes, by what they mark.
MARKS = {
    ".menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar pagination pager toc tabs skip sitemap",
    ".header": "header masthead banner logo branding tagline hero",
    ".footer": "footer foot bottom copyright colophon legal imprint",
    ".side": "sidebar side aside rail widget widgets secondary complementary",
    ".notice": "cookie cookies consent gdpr notice notices alert alerts warning popup modal overlay toast disclaimer paywall notification privacy",
    ".advert": "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promoted promotion adsense dfp taboola outbrain",
    ".form": "form login signin signup subscribe subscription newsletter search register contact",
    ".comment": "comment comments commentlist commenter reply replies respond response responses disqus discussion feedback guestbook reader",
    ".related": "related recommended recommendations more popular trending latest teaser teasers share sharing social tags tagcloud meta author byline bio print",
    ".content": "content article articlebody post entry story body text main maintext prose copy page hentry",
}
APART = frozenset("nav header footer aside form dialog button label fieldset hidden".split()) | (MARKS.keys() - {".content"})
MARK_OF = {word: mark for mark, words in MARKS.items() for word in words.split()}

# Words of a text that notices, forms and links of a page tend to hold.
TELLING = {
    "cookie": "cookie cookies consent gdpr datenschutz privacy",
    "form": "subscribe newsletter password login e-mail email register username abonnieren suscribirse",
    "share": "share tweet facebook twitter instagram whatsapp pinterest",
    "comment": "comment comments reply replies kommentar kommentare commentaire commentaires comentario comentarios",
    "advert": "advertisement sponsored anzeige werbung publicité publicidad",
    "rights": "copyright reserved impressum rechte droits derechos",
}
TELLING_OF = {word: kind for kind, words in TELLING.items() for word in words.split()}

TOKEN = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
MARK_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
PLAIN_WORD = re.compile(r"[^\W\d_][\w-]*")
MEMORY = 50_000
"""Element paths whose features a task remembers."""


class Block(NamedTuple):
    text: str
    tag: str
    parent: str
    inside: frozenset
    container: int
    words: int
    linked: int


def _marks(attributes: str) -> set[str]:
    found = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            found.update(MARK_OF[w] for w in map(str.lower, MARK_WORD.findall(value)) if w in MARK_OF)
        elif name == "role":
            found.update(ROLES[w] for w in value.lower().split() if w in ROLES)
        elif name == "hidden" or value.lower() == "true" and name == "aria-hidden" or re.search(
                r"display\s*:\s*none", value, re.I):
            found.add("hidden")
    return found


class _Reader:
    """Open elements and the block that is being read."""

    seen: dict[tuple, frozenset] = {}

    def __init__(self) -> None:
        self.open = [("", frozenset(), 0)]  # name, features of the path, number of the container
        self.containers = 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.words = self.linked = 0
        self.in_link = False

    def text(self, piece: str) -> None:
        if "&" in piece:
            piece = unescape(piece)
        n = len(piece.split())
        self.words += n
        if self.in_link:
            self.linked += n
        self.parts.append(piece)

    def end_block(self) -> None:
        if self.words:
            name, inside, container = self.open[-1]
            parent = self.open[-2][0] if len(self.open) > 1 else ""
            text = " ".join("".join(self.parts).split())
            self.blocks.append(Block(text, name, parent, inside, container, text.count(" ") + 1, self.linked))
        self.parts.clear()
        self.words = self.linked = 0

    def start(self, name: str, attributes: str) -> None:
        if self.open[-1][0] == "p":
            self.open.pop()
        closed, border = CLOSES.get(name, ((), ()))
        for at in range(len(self.open) - 1, 0, -1) if closed else ():
            if self.open[at][0] in closed:
                del self.open[at:]
                break
            if self.open[at][0] in border:
                break
        if name in EMPTY:
            return
        above = self.open[-1]
        key = (above[1], name, attributes)
        inside = self.seen.get(key)
        if inside is None:
            inside = above[1] | {name} | (_marks(attributes) if attributes else set())
            if len(self.seen) > MEMORY:
                self.seen.clear()
            self.seen[key] = inside
        container = above[2]
        if name in CONTAINERS:
            self.containers += 1
            container = self.containers
        self.open.append((name, inside, container))

    def end(self, name: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == name:
                del self.open[at:]
                return


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks that have text, in page order."""
    reader, at = _Reader(), 0
    while True:
        token = TOKEN.search(page, at)
        if token is None:
            reader.text(page[at:])
            reader.end_block()
            return reader.blocks
        if token.start() > at:
            reader.text(page[at:token.start()])
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing = token[1] or token[4]
        if name in SKIPPED:
            if not closing:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page) if name in TO_THE_END else at
        elif name == "br":
            reader.parts.append(" ")
        elif name == "a":
            reader.in_link = not closing
        elif name in BLOCK:
            reader.end_block()
            if closing:
                reader.end(name)
            else:
                reader.start(name, token[3] or token[6] or "")


def _step(n: float, *bounds: float) -> int:
    return sum(n >= b for b in bounds)


def features(blocks: list[Block]) -> list[list[str]]:
    """The names of each block's features."""
    prose: dict[int, int] = defaultdict(int)
    for b in blocks:
        if b.words >= 8 and b.linked * 3 < b.words:
            prose[b.container] += b.words
    densest, total = max(prose, key=prose.get, default=-1), max(1, sum(prose.values()))
    there = frozenset().union(*(b.inside for b in blocks)) & {"article", "main", ".content"}
    sizes = [_step(b.words, 2, 5, 10, 20, 50) if b.linked * 2 < b.words else -1 for b in blocks]
    found = []
    for at, b in enumerate(blocks):
        size, links = _step(b.words, 2, 5, 10, 20, 50), _step(b.linked / max(1, b.words), .01, .34, .67, .99)
        ends = b.text[-1] if b.text[-1] in ".!?:…" else "-"
        has = ["any", f"tag {b.tag}", f"tag {b.tag} in {b.parent}", f"words {size}", f"links {links}", f"words {size} links {links}",
               f"tag {b.tag} words {size}", f"ends {ends}", f"ends {ends} words {size}",
               f"share {_step(prose.get(b.container, 0) / total, .01, .1, .3, .6)}"]
        around = "apart" if b.inside & APART else "plain"
        has += [around, *(f"{around} in {x}" for x in b.inside & there), f"{around} {'out of' if there - b.inside else 'in'} all"]
        has += [f"in {x}" for x in b.inside]
        has += [f"not in {x}" for x in there - b.inside]
        has += [f"tag {b.tag} in {x}" for x in b.inside & {"article", "main", ".content"}]
        has.append(f"before {sizes[at - 1] if at else 'none'}")
        has.append(f"after {sizes[at + 1] if at + 1 < len(blocks) else 'none'}")
        if b.container == densest:
            has.append("densest")
        if b.text[0] in "©Ⓒ" or "©" in b.text[:40]:
            has.append("says rights")
        if b.words <= 60:  # a long text may speak of anything
            has += {f"says {TELLING_OF[w]}" for w in map(str.lower, PLAIN_WORD.findall(b.text)) if w in TELLING_OF}
        found.append(has)
    return found
