"""Pages whose main blocks are known, to train and test the extractor.

Pages are put together from parts: an article in one of several containers, and around
and inside it menus, headers, footers, sidebars, notices, adverts, forms, related links
and comments, under the element names, classes and roles that web pages use, some
without any. Their words are invented. A main block begins with ``MARK``.
"""

from __future__ import annotations

import random
from functools import lru_cache

from vaultloom.llm.html_blocks import Block, features, leaf_blocks

MARK = "\ue000"
LONGEST = 60
"""Blocks of a page; longer ones are left out, as the shorter say the same."""
SYLLABLES = "an be cho dra el fi gu hin ion ka lem mo ni or pé qui ra sto tu ur vé wa ze ßen ñar ção ты и".split()
COMMON = "the of and a in to is der die und das la de el que et les un по на".split()


class _Writer:
    def __init__(self, rng: random.Random) -> None:
        self.rng = rng
        self.words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def some(self, low: int, high: int) -> str:
        rng = self.rng
        return " ".join(rng.choice(COMMON if rng.random() < .35 else self.words) for _ in range(rng.randint(low, high)))

    def title(self) -> str:
        return self.some(2, 12).capitalize() + self.rng.choice(["", "", "", "?", "!"])

    def prose(self, low: int, high: int) -> str:
        """Sentences, now and then with markup inside."""
        rng, found = self.rng, []
        for _ in range(rng.randint(low, high)):
            s = self.some(3, 22).capitalize() + rng.choice([".", ".", ".", "!", "?"])
            if rng.random() < .12:
                s = f'<a href="/{self.some(1, 1)}">{s}</a>' if rng.random() < .4 else f"<{(t := rng.choice(['b', 'em', 'span', 'i']))}>{s}</{t}>"
            found.append(s)
        text = rng.choice([" ", " ", "<br>"]).join(found)
        if rng.random() < .1:  # torn or garbled text
            text = text.rstrip(".!?") + rng.choice(["", ",", " |", " -", "%%%"])
            text = rng.choice([" ", " ", " | ", "### ", " a "]).join(text.split(" ")) if "<" not in text else text
        return text

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.some(1, 1)}">{self.some(low, high).capitalize()}</a>'

    def links(self, low: int = 2, high: int = 9, most: int = 3) -> str:
        rng, n = self.rng, self.rng.randint(low, high)
        tag = rng.choice(["li", "li", "span", "div"])
        found = "".join(f"<{tag}>{self.link(1, most)}</{tag}>" for _ in range(n))
        return f"<ul>{found}</ul>" if tag == "li" else rng.choice(["", " | "]).join([found])

    def within(self, choices: list[str], inner: str) -> str:
        """``inner`` in one of the elements, each given as its start tag's text."""
        start = self.rng.choice(choices)
        return f"<{start}>{inner}</{start.split()[0]}>"


def _main_blocks(w: _Writer) -> str:
    rng, found = w.rng, []
    for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 14])):
        kind = rng.random()
        if kind < .68:
            tag = rng.choice(["p", "p", "p", "p class=para", "div", "div class=paragraph"])
            text = w.some(1, 6).capitalize() + rng.choice([".", ".", "", "!"]) if rng.random() < .2 else w.prose(1, 9)
            unclosed = tag.startswith("p") and rng.random() < .2
            found.append(f"<{tag}>{rng.choice(['', '', '<b>'])}{MARK}{text}" + ("" if unclosed else f"</{tag.split()[0]}>"))
        elif kind < .80:
            level = rng.choice(["h2", "h3"])
            found.append(f"<{level}>{MARK}{w.title()}</{level}><p>{MARK}{w.prose(1, 6)}</p>")
        elif kind < .88:
            items = "".join(f"<li>{MARK}{w.prose(1, 2) if rng.random() < .6 else w.some(1, 8)}</li>" for _ in range(rng.randint(2, 6)))
            found.append(f"<ul>{items}</ul>" if rng.random() < .6 else f"<ol>{items}</ol>")
        elif kind < .92:
            found.append(f"<blockquote>{rng.choice(['', '<p>'])}{MARK}{w.prose(1, 3)}</blockquote>")
        elif kind < .95:
            rows = "".join(f"<tr><td>{MARK}{w.some(1, 4)}</td><td>{MARK}{w.some(1, 4)}</td></tr>" for _ in range(rng.randint(2, 4)))
            found.append(f"<table>{rows}</table>")
        elif kind < .975:
            found.append(f"<figure><img src=x><figcaption>{MARK}{w.prose(1, 1)}</figcaption></figure>")
        else:
            found.append(f"<pre>{MARK}{w.some(3, 20)}</pre>")
        if rng.random() < .06:
            found.append(_advert(w))
        elif rng.random() < .03:
            found.append(rng.choice([_related, _notice, _form, _menu])(w))
    return "".join(found)


def _article(w: _Writer) -> str:
    rng = w.rng
    title = "" if rng.random() < .15 else f"<h1>{MARK}{w.title()}</h1>"
    if title and rng.random() < .15:
        title = f"<header>{title}</header>"
    inner = title + _main_blocks(w)
    if rng.random() < .1:
        inner += f"<footer>{w.links()}</footer>" if rng.random() < .5 else f"<footer><p>{w.some(3, 12)}</p></footer>"
    if rng.random() < .1:
        inner += _comments(w)
    kind = rng.random()
    if kind < .45:
        found = w.within(["article", "article", "article class=post", "article id=story"], inner)
    elif kind < .8:
        found = w.within(['div class="content"', 'div id=main-content', 'div class="post-body entry"', "div class=article",
                          "section class=story", 'div role="main"', "main", "main", "div", "section", "td"], inner)
        if found.startswith("<td"):
            found = f"<table><tr>{found}</tr></table>"
    else:
        found = inner if rng.random() < .4 else f"<div><div>{inner}</div></div>"
    return w.within(["main", "div id=wrapper", "div class=container", "div"], found) if rng.random() < .35 else found


def _menu(w: _Writer) -> str:
    return w.within(["nav", "nav", "nav class=menu", "div class=navbar", "div id=menu", 'div class="breadcrumbs"', 'div role="navigation"',
                     "ul class=nav-list", "div"], w.links())


def _header(w: _Writer) -> str:
    rng = w.rng
    inner = rng.choice(["", f"<h1>{w.some(1, 3)}</h1>", f"<div class=logo>{w.link()}</div>", f"<p>{w.some(3, 9)}.</p>", f"<p>{w.prose(1, 2)}</p>"])
    return w.within(["header", "header", "header class=site-header", "div id=header", "div class=masthead", 'div role="banner"'],
                    inner + rng.choice(["", _menu(w), w.link()]) or w.some(1, 5))


def _footer(w: _Writer) -> str:
    rng = w.rng
    says = rng.choice(["&copy; ", "© ", "Copyright ", "", ""]) + rng.choice([w.some(1, 5), w.prose(1, 3)]) + rng.choice(["", " All rights reserved."])
    inner = rng.choice([says, f"<p>{says}</p>", f"<p>{says}</p>{w.links()}", f"<div>{w.links()}</div><small>{says}</small>"])
    return w.within(["footer", "footer", "footer", "div id=footer", "div class=site-footer", 'div role="contentinfo"'], inner)


def _side(w: _Writer) -> str:
    parts = [f"<h3>{w.some(1, 4)}</h3>{w.links(2, 8, 9)}", f"<p>{w.prose(1, 4)}</p>", f"<h2>{w.title()}</h2><p>{w.prose(1, 3)}</p>",
             f"<div>{w.prose(1, 2)}</div>"]
    inner = "".join(w.rng.sample(parts, w.rng.randint(1, 3)))
    return w.within(["aside", "aside", "aside class=sidebar", "div class=sidebar", "div id=right-rail", 'div class="widget"',
                     'div role="complementary"', 'section class="secondary"'], inner)


def _notice(w: _Writer) -> str:
    rng = w.rng
    says = rng.choice(["We use cookies. ", "Cookies: ", "", "", ""]) + w.prose(1, 3)
    inner = rng.choice([says, f"<p>{says}</p>", f"<p>{says}</p><button>{w.some(1, 2)}</button>", f"<p>{says} {w.link()}</p>"])
    return w.within(["div class=cookie-banner", 'div id="cookie-consent"', "div class=notice", "div class=alert", "p class=notice", 'div role="alert"',
                     "section class=popup", "dialog open", "div class=modal", 'div role="dialog"', "div class=disclaimer", "aside class=notice"], inner)


def _advert(w: _Writer) -> str:
    inner = w.rng.choice([w.prose(1, 3), f"<p>{w.prose(1, 3)}</p>", f"<h3>{w.title()}</h3><p>{w.prose(1, 2)}</p>", w.link(2, 8), f"<p>{w.link(2, 8)}</p>"])
    return w.within(["div class=ad", "div class=ad", "div class=advert", 'div id="ad-1"', "aside class=sponsored", "section class=promo",
                     "p class=advertisement", "div class=adsense", "ins class=adsbygoogle", "div class=banner-ad"], inner)


def _form(w: _Writer) -> str:
    inner = w.rng.choice([
        f"<label>{w.some(1, 3)}</label><input><button>{w.some(1, 2)}</button>", f"<p>{w.prose(1, 2)}</p><input type=email><button>{w.some(1, 2)}</button>",
        f"<h3>{w.title()}</h3><label>{w.some(1, 4)} <input></label><select><option>{w.some(1, 1)}<option>{w.some(1, 1)}</select>",
        f"<fieldset><legend>{w.some(1, 3)}</legend>{w.some(2, 9)} <input></fieldset>"])
    return w.within(["form", "form", "form class=search", "form action=/login"], inner) if w.rng.random() < .8 else w.within(
        ["div class=newsletter", "div class=signup", "section id=subscribe", "div class=login-box"], inner)


def _related(w: _Writer) -> str:
    inner = f"<h3>{w.some(1, 4)}</h3>" + w.rng.choice([w.links(2, 6, 12), "".join(f"<div>{w.link(3, 9)}<p>{w.prose(1, 1)}</p></div>" for _ in range(3))])
    return w.within(["div class=related", "section class=related-posts", "aside class=recommended", "div id=more-stories", 'div class="share"',
                     "div class=tags", "nav class=pager"], inner)


def _comments(w: _Writer) -> str:
    rng = w.rng
    one = rng.choice(["div class=comment", "li class=comment", "article class=comment", "div", "p", "blockquote", "div class=reply"])
    made = []
    for _ in range(rng.randint(1, 6)):
        text = w.prose(1, 4)
        made.append(f"<{one}>" + rng.choice([text, f"<p>{text}</p>", f"<b>{w.some(1, 2)}</b><p>{text}</p>", f"<div>{w.some(1, 3)}</div><div>{text}</div>"])
                    + f"</{one.split()[0]}>")
    inner = rng.choice([f"<h2>{w.some(1, 3)}</h2>", "<h3>Comments</h3>", "<h2>3 comments</h2>", ""]) + "".join(made)
    return w.within(["section id=comments", "div class=comments", "section class=comments", "ol class=commentlist", 'div id="disqus_thread"',
                     "div class=responses", 'aside class="reader-comments"', 'div class="discussion"'], inner)


def labelled_page(seed: int) -> str:
    """The page of a number, main blocks marked."""
    rng = random.Random(seed)
    w = _Writer(rng)
    before = [part(w) for part, chance in ((_notice, .3), (_header, .55), (_menu, .7), (_form, .2), (_advert, .35), (_side, .15)) if rng.random() < chance]
    after = [part(w) for part, chance in ((_advert, .25), (_related, .3), (_comments, .35), (_side, .35), (_form, .2), (_notice, .2), (_menu, .15))
             if rng.random() < chance]
    rng.shuffle(after)
    if rng.random() < .2:
        rng.shuffle(before)
    if rng.random() < .08:  # nothing of an article
        body = [*before, *after]
    else:
        body = [*before, _article(w), *after]
    if rng.random() < .65:
        body.append(_footer(w))
    if rng.random() < .03:  # a text without elements
        return MARK + w.some(1, 200)
    inner = "".join(body)
    head = f"<!DOCTYPE html><html><head><title>{w.title()}</title><style>p{{}}</style><script>var a='</p>';</script></head>"
    return rng.choice([f"{head}<body>{inner}</body></html>", f"{head}<body>{inner}", f"<body>{inner}</body>", inner])


def _bare(b: Block) -> Block:
    text = b.text.replace(MARK, "")
    return b._replace(text=text or "-")


@lru_cache(maxsize=4)
def labelled_sequences(pages: int, seed: int = 0) -> list[tuple[list[list[str]], list[int]]]:
    """(features of each block, whether it is main) of so many pages."""
    found = []
    for n in range(seed, seed + pages):
        blocks = leaf_blocks(labelled_page(n))
        found.append((features([_bare(b) for b in blocks]), [int(MARK in b.text) for b in blocks]))
    return [s for s in found if s[1] and len(s[1]) <= LONGEST]
