"""Labelled web pages for training: random pages of common layouts, whose text is known as they are written."""

from __future__ import annotations

from html import escape
from random import Random

# Syllables and names that pages are written with.
_SYLLABLES = "ba re ti lo mun ka sel dor vi an te ro ni ush pal gor em ist".split()
_CONTENT = ["article", "main", "article class='post'", "div class='content'", "div id='main-content'", "section class='entry-content'", "div class='story-body'", "div class='article-text'", "div itemprop='articleBody'", "div class='post-body prose'"]
#: Boxes around an article whose names say nothing, as many page builders write them.
_UNNAMED = ["div", "section", "div class='css-1q7'", "div class='c4 x2'", "div id='r7'", "td"]
_PLAIN = ["div", "section", "div class='wrapper'", "div class='row'", "div id='page'"]
_BOXES = {
    "menu": ["nav", "nav class='menu'", "div class='nav'", "ul class='menu'", "div id='navigation'", "div class='breadcrumbs'", "div role='navigation'"],
    "header": ["header", "div class='header'", "header class='site-header'", "div id='masthead'", "div class='topbar header'"],
    "footer": ["footer", "div class='footer'", "footer class='site-footer'", "div id='footer'", "div class='copyright'"],
    "side": ["aside", "div class='sidebar'", "aside class='widget'", "div id='sidebar'", "div class='related'", "section class='recommended'"],
    "advert": ["div class='ad'", "div class='ads'", "div class='advertisement'", "aside class='sponsored'", "div id='ad-slot'", "section class='promo'"],
    "notice": ["div class='cookie-notice'", "div id='consent'", "div class='notice'", "div class='alert'", "div class='newsletter-signup'", "section class='popup'", "div class='banner notice'"],
    "form": ["form", "form class='search'", "div class='login-form'", "form id='contact'"],
    "comments": ["section class='comments'", "div id='comments'", "div class='comment-list'", "section id='disqus_thread'", "div class='reader-comments'", "div class='replies'", "ol class='comments'"],
}


class _Writer:
    def __init__(self, random: Random):
        self.random = random
        self.used: set[str] = set()

    def words(self, least: int, most: int, stop: bool) -> str:
        """Random words that the page does not hold yet, so that its text tells content from the rest."""
        while (text := self._words(least, most, stop)) in self.used:
            pass
        self.used.add(text)
        return text

    def _words(self, least: int, most: int, stop: bool) -> str:
        r = self.random
        out = []
        for _ in range(r.randint(least, most)):
            word = "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))
            out.append(word.capitalize() if not out or out[-1].endswith(".") else word + r.choice(["", "", "", "", ".", ",", " &"]))
        return " ".join(out).rstrip(".,& ") + ("." if stop else "")

    def tagged(self, tag: str, inner: str) -> str:
        return f"<{tag}>{inner}</{tag.split(' ')[0]}>"

    def paragraph(self) -> str:
        r = self.random
        return self.words(1, 4, True) if r.random() < 0.2 else self.words(4, 90, r.random() < 0.9)

    def content(self, block: str = "p") -> tuple[str, list[str]]:
        """Inner html of an article, with its blocks; block: the element of its paragraphs."""
        r, html, lines = self.random, "", []

        def add(tag: str, text: str, shown: str | None = None) -> str:
            lines.append(text)
            return self.tagged(tag, shown or escape(text))

        if r.random() < 0.8:
            title = add("h1", self.words(2, 16, r.random() < 0.6))
            html += self.tagged("header", title) if r.random() < 0.1 else title
        if block == "a":
            # A list of stories: links are all that it has.
            told = ""
            for _ in range(r.randint(3, 9)):
                lines.append(text := self.words(4, 16, r.random() < 0.3))
                told += self.tagged("li", f"<a href='/s'>{escape(text)}</a>")
            return html + self.tagged("ul", told), lines
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 13])):
            kind = r.random()
            text = self.paragraph()
            if kind < 0.1:
                html += add("h2", self.words(1, 8, False))
            elif kind < 0.22:
                html += self.tagged("ul", "".join(add("li", self.words(1, 14, r.random() < 0.5)) for _ in range(r.randint(2, 5))))
            elif kind < 0.3:
                link = self.words(1, 3, False)
                html += add("p", f"{text} {link}", f"{escape(text)} <a href='/x'>{escape(link)}</a>")
            elif kind < 0.35:
                html += self.tagged("blockquote", add("p", text))
            elif kind < 0.39:
                html += self.tagged("table", self.tagged("tr", add("td", text) + add("td", self.words(1, 6, False))))
            elif kind < 0.43:
                html += self.tagged("div", add("p", text))
            else:
                html += add(block, text)
            if r.random() < 0.06:
                html += self.box(r.choice(["advert", "side", "form", "notice"]))
        return html, lines

    def box(self, kind: str) -> str:
        """A box that is not content."""
        r = self.random
        links = "".join(f"<li><a href='/{i}'>{escape(self.words(1, 3, False))}</a></li>" for i in range(r.randint(2, 8)))
        short = lambda: self.tagged(r.choice(["p", "p", "div", "span"]), escape(self.words(2, 14, r.random() < 0.6) if r.random() < 0.6 else self.paragraph()))
        inner = {
            "menu": lambda: self.tagged("ul", links),
            "header": lambda: r.choice([self.tagged("div class='logo'", escape(self.words(1, 4, False))), short(), self.tagged("h1", escape(self.words(1, 4, False))), self.tagged("h1", escape(self.words(1, 4, False))) + short(), self.tagged("p", escape(self.paragraph()))]) + (self.tagged("ul", links) if r.random() < 0.5 else ""),
            "footer": lambda: r.choice(["&copy; " + escape(self.words(1, 20, r.random() < 0.6)), self.tagged("p", "&copy; 2020 " + escape(self.words(1, 9, False))), short() + self.tagged("ul", links)]),
            "side": lambda: r.choice([self.tagged("h3", escape(self.words(1, 4, False))) + self.tagged("ul", links), short(), self.tagged("p", escape(self.paragraph()))]),
            "advert": lambda: r.choice([escape(self.words(2, 20, r.random() < 0.8)), short(), f"<a href='/ad'>{escape(self.words(2, 8, False))}</a>"]),
            "notice": lambda: r.choice([escape(self.words(4, 25, True)), short() + "<button>Ok</button>"]),
            "form": lambda: "<label>" + escape(self.words(1, 3, False)) + "</label><input name='q'>" + r.choice(["<button>Go</button>", short()]),
            "comments": lambda: self.tagged("h3", "Comments") * r.randint(0, 1)
            + "".join(self.tagged(r.choice(["div class='comment'", "li class='comment'", "div", "article class='comment'"]), r.choice(["<b>" + self.words(1, 1, False) + "</b>", ""]) + self.tagged("p", escape(self.paragraph()))) for _ in range(r.randint(1, 6))),
        }[kind]()
        tag = r.choice(_BOXES[kind])
        return self.tagged(tag, inner)

    def page(self) -> tuple[str, str]:
        r = self.random
        self.used = set()
        tag, block = r.choice(_CONTENT), "p"
        if (style := r.random()) < 0.35:
            tag, block = r.choice(_UNNAMED), r.choice(["div", "div", "p"])
        elif style < 0.5:
            block = "div"
        elif style < 0.6:
            tag, block = r.choice(_CONTENT[:2]), "a"
        article, lines = self.content(block)
        for kind, chance in (("comments", 0.2), ("form", 0.08), ("side", 0.08), ("footer", 0.06), ("menu", 0.05), ("advert", 0.08)):
            if r.random() < chance:
                article += self.box(kind)
        body = self.tagged(tag, article)
        some = lambda kinds, chance: "".join(self.box(k) for k in kinds if r.random() < chance)
        body = some(["advert", "side"], 0.25) + body + some(["side", "comments", "advert", "form"], 0.35)
        for _ in range(r.choice([0, 0, 1, 2])):
            body = self.tagged(r.choice(_PLAIN), body)
        body = some(["notice", "header", "menu", "form", "advert"], 0.5) + body + some(["footer", "notice"], 0.6)
        head = "<title>" + escape(self.words(1, 9, False)) + "</title><style>p{margin:0}</style>"
        return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>", "\n".join(lines)


def labelled_pages(n: int = 2000, seed: int = 7) -> list[tuple[str, str]]:
    """(html, text) of n pages."""
    writer = _Writer(Random(seed))
    return [writer.page() for _ in range(n)]
