"""Leaf blocks of an HTML page, and generated pages with labels to train on."""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav ol option optgroup p pre "
    "section select summary table tbody td textarea tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED_TAGS = frozenset("script style noscript template head title iframe audio video canvas".split())
_IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
_CLOSED_BY = {"p": BLOCK_TAGS - {"button"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
              "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}}
_SECTIONS = frozenset("article main section header footer nav aside form figure blockquote".split())
_SCOPES = frozenset("table ul ol dl div article section main aside nav form body header footer".split())
_TOKEN = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Leaf:
    """Text of one leaf block with what its ancestors are called."""
    text: str
    parent: str
    tags: frozenset[str]
    names: frozenset[str]
    sections: str
    linked: int
    mark: str


@dataclass(frozen=True)
class _Open:
    """An open element, with what it and its ancestors add up to (shared while nothing is new)."""
    tag: str = ""
    tags: frozenset[str] = frozenset()
    names: frozenset[str] = frozenset()
    sections: tuple[str, ...] = ()
    mark: str = ""

    def child(self, tag: str, names: list[str], mark: str) -> _Open:
        return _Open(tag, self.tags if tag in self.tags else self.tags | {tag},
                     self.names if self.names.issuperset(names) else self.names.union(names),
                     (*self.sections[-1:], tag) if tag in _SECTIONS else self.sections, mark or self.mark)


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = [_Open()]
        self.counts: Counter[str] = Counter()
        self.leaves: list[Leaf] = []
        self.parts: list[str] = []
        self.skipping = self.links = self.linked = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.open[-1]
            self.leaves.append(Leaf(text, top.tag, top.tags, top.names, ">".join(top.sections), min(self.linked, len(text)), top.mark))
        self.parts, self.linked = [], 0

    def _pop(self, at: int) -> None:
        for x in self.open[at:]:
            self.counts[x.tag] -= 1
            self.skipping -= x.tag in SKIPPED_TAGS
            self.links -= x.tag == "a"
        del self.open[at:]

    def _leave_head(self) -> None:
        self._flush()
        self._pop(next(k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag == "head"))

    def handle_starttag(self, tag, attrs):
        if self.counts["head"] and tag not in _IN_HEAD and (
                self.open[-1].tag == "head" or (tag == "body" and not self.counts["title"])):
            self._leave_head()
        if tag in BLOCK_TAGS:
            self._flush()
            if any(self.counts[k] and tag in closers for k, closers in _CLOSED_BY.items()):
                for k in range(len(self.open) - 1, 0, -1):
                    kind = self.open[k].tag
                    if tag in _CLOSED_BY.get(kind, ()):
                        self._pop(k)
                        break
                    if kind in _SCOPES:
                        break
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID_TAGS:
            return
        words = " ".join(_CAMEL.sub(" ", v or "") for k, v in attrs if k in ("class", "id", "role", "itemprop"))
        mark = next((v or "" for k, v in attrs if k == "data-label"), "")
        self.open.append(self.open[-1].child(tag, _TOKEN.findall(words.lower()), mark))
        self.counts[tag] += 1
        self.skipping += tag in SKIPPED_TAGS
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag not in BLOCK_TAGS:  # HTML ignores the slash on others
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self._flush()
        if self.counts[tag]:
            self._pop(next(k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag == tag))

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._leave_head()
        if not self.skipping:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def leaves(html: str | None) -> list[Leaf]:
    """Leaf blocks in page order; character references decoded, white space made single and trimmed."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader._flush()
    return reader.leaves


# --- generated pages ---------------------------------------------------------------------

_SYLLABLES = "ba de ki lo mu ra se ti vo na pe shi gra tor men li us an er on ig".split()


class _Writer:
    """Writes one page; every part carries its label, 1 for the article and 0 for the rest."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def word(self) -> str:
        return "".join(self.rng.choice(_SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high))).capitalize()

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.phrase(3, 16) + self.rng.choice("...?!") for _ in range(self.rng.randint(low, high)))

    def named(self, tags: str, names: str, inner: str, label: int) -> str:
        """``inner`` in one of ``tags``, usually with one of ``names`` as class or id."""
        tag, name = self.rng.choice(tags.split()), self.rng.choice(names.split())
        style = self.rng.choice(["class", "class", "id"])
        if self.rng.random() < 0.3:
            name += self.rng.choice(["-box", "-wrapper", " clearfix", "_1", "-container", " block"])
        attr = f' {style}="{name}"' if tag in ("div", "section", "ul", "span", "p") or self.rng.random() < 0.5 else ""
        return f'<{tag}{attr} data-label="{label}">{inner}</{tag}>'

    def links(self, low: int, high: int, tag: str = "li") -> str:
        made = "".join(f'<{tag}><a href="/{self.word()}">{self.phrase(1, 3)}</a></{tag}>' for _ in range(self.rng.randint(low, high)))
        return f"<ul>{made}</ul>" if tag == "li" else made

    def menu(self) -> str:
        return self.named("nav nav div ul", "menu nav navbar navigation main-nav topnav breadcrumbs links", self.links(3, 9), 0)

    def head(self) -> str:
        inner = f"<h1>{self.phrase(1, 3)}</h1>" if self.rng.random() < 0.4 else f"<a href='/'>{self.phrase(1, 3)}</a>"
        inner += f"<p>{self.phrase(2, 8)}</p>" if self.rng.random() < 0.5 else ""
        return self.named("header header div", "header site-header masthead top-bar branding", inner, 0)

    def notice(self) -> str:
        inner = f"<p>{self.prose(1, 3)}</p>" if self.rng.random() < 0.6 else self.prose(1, 2)
        inner += f"<button>{self.phrase(1, 2)}</button>" if self.rng.random() < 0.5 else ""
        return self.named("div div section aside", "cookie-notice cookie-banner cookies notice alert consent gdpr popup modal disclaimer message", inner, 0)

    def advert(self) -> str:
        inner = self.rng.choice([self.prose(1, 3), f"<p>{self.prose(1, 2)}</p>", f"<a href='#'>{self.phrase(2, 8)}</a>"])
        return self.named("div div aside section p", "ad ads advert advertisement sponsored sponsor promo banner ad-slot adsbygoogle", inner, 0)

    def side(self) -> str:
        inner = f"<h3>{self.phrase(1, 3)}</h3>" + self.rng.choice([self.links(3, 8), f"<p>{self.prose(1, 4)}</p>"])
        return self.named("aside aside div section", "sidebar side-bar widget related recommended trending popular more-stories", inner, 0)

    def form(self) -> str:
        inner = f"<label>{self.phrase(1, 3)}</label><input type='text'><button>{self.phrase(1, 2)}</button>"
        inner = (f"<p>{self.prose(1, 2)}</p>" if self.rng.random() < 0.5 else "") + inner
        return f'<form data-label="0">{inner}</form>' if self.rng.random() < 0.6 else self.named(
            "div section", "newsletter subscribe signup login search-form contact-form", f"<form>{inner}</form>", 0)

    def share(self) -> str:
        return self.named("div ul", "share social sharing tags buttons", self.links(2, 5), 0)

    def comments(self) -> str:
        one = lambda: self.rng.choice([
            f"<div class='comment'><b>{self.phrase(1, 2)}</b><p>{self.prose(1, 6)}</p></div>",
            f"<li>{self.phrase(1, 2)}: {self.prose(1, 5)}</li>", f"<article class='comment'><p>{self.prose(1, 6)}</p></article>"])
        inner = f"<h3>{self.phrase(1, 2)}</h3>" + "".join(one() for _ in range(self.rng.randint(1, 5)))
        return self.named("section div div ol", "comments comment-list comments-area reader-comments discussion replies responses", inner, 0)

    def foot(self) -> str:
        inner = self.rng.choice([f"&copy; {self.word()} &middot; {self.phrase(2, 8)}.", f"<p>{self.phrase(2, 8)}</p>" + self.links(2, 6),
                                 self.links(2, 6), f"<p>{self.prose(1, 2)}</p>"])
        return self.named("footer footer div", "footer site-footer copyright legal colophon bottom", inner, 0)

    def paragraph(self) -> str:
        kind = self.rng.random()
        if kind < 0.62:
            return f"<p>{self.prose(1, 8)}</p>"
        if kind < 0.72:
            return f"<p><b>{self.phrase(2, 12)}.<br>"
        if kind < 0.78:
            return f"<h{self.rng.randint(2, 4)}>{self.phrase(2, 8)}</h2>"
        if kind < 0.84:
            return "<ul>" + "".join(f"<li>{self.phrase(2, 14)}</li>" for _ in range(self.rng.randint(2, 6))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote><p>{self.prose(1, 3)}</p></blockquote>"
        if kind < 0.91:
            return "<table>" + "".join(f"<tr><td>{self.phrase(1, 3)}</td><td>{self.phrase(1, 4)}</td></tr>" for _ in range(3)) + "</table>"
        if kind < 0.94:
            return f"<figure><img src='x.png'><figcaption>{self.phrase(3, 12)}</figcaption></figure>"
        if kind < 0.97:
            return f"<div><p>{self.prose(1, 4)} <a href='#'>{self.phrase(1, 3)}</a> {self.prose(1, 2)}</p></div>"
        return f"<pre>{self.phrase(2, 20)}</pre>"

    def article(self) -> str:
        parts = [f"<h1>{self.phrase(2, 12)}</h1>"] if self.rng.random() < 0.85 else []
        if parts and self.rng.random() < 0.15:
            parts = [f"<header>{parts[0]}</header>"]
        for _ in range(self.rng.choice([1, 1, 2, 3, 5, 8, 12, 20])):
            parts.append(self.paragraph())
            if self.rng.random() < 0.1:
                parts.append(self.rng.choice([self.advert, self.share, self.side, self.form])())
        inner = "".join(parts)
        if self.rng.random() < 0.1:
            inner += self.comments()
        kind = self.rng.random()
        if kind < 0.4:
            return f'<article data-label="1">{inner}</article>'
        if kind < 0.5:
            return f'<main data-label="1">{inner}</main>'
        if kind < 0.6:
            return f'<main><article data-label="1">{inner}</article></main>'
        if kind < 0.85:
            return self.named("div section", "content article post entry-content post-body story main text body-text page-content", inner, 1)
        return f'<div data-label="1">{inner}</div>' if kind < 0.93 else inner  # the body's label holds

    def page(self) -> str:
        if self.rng.random() < 0.05:  # nothing but text
            return self.rng.choice([f"<p data-label='1'>{self.prose(1, 4)}", f"<body data-label='1'>{self.prose(1, 5)}",
                                    f"<div data-label='1'><h1>{self.phrase(2, 8)}</h1>{self.prose(1, 3)}</div>"])
        some = lambda p, make: make() if self.rng.random() < p else ""
        before = [some(0.5, self.head), some(0.8, self.menu), some(0.3, self.notice), some(0.5, self.advert), some(0.2, self.side), some(0.15, self.form)]
        after = [some(0.2, self.share), some(0.35, self.side), some(0.3, self.advert), some(0.4, self.comments), some(0.25, self.form), some(0.2, self.notice)]
        if self.rng.random() < 0.4:
            self.rng.shuffle(before)
            self.rng.shuffle(after)
        return ("<!DOCTYPE html><html><head><title>" + self.phrase(2, 8) + "</title><script>var t='<p>';</script></head><body data-label='1'>"
                + "".join(before) + self.article() + "".join(after) + some(0.85, self.foot) + "</body></html>")


def labelled_pages(n: int, seed: int) -> list[tuple[list[Leaf], list[int]]]:
    """``n`` generated pages as leaves with their labels."""
    writer, out = _Writer(random.Random(seed)), []
    for _ in range(n):
        found = leaves(writer.page())
        out.append((found, [int(x.mark == "1") for x in found]))
    return out
