"""Pages: malformed markup, linear time, and an independent parser."""

from __future__ import annotations

import random
import time
from html.parser import HTMLParser

import pytest

from pluvio.llm import html_text, labelled_pages, registry

MODEL = html_text.train(labelled_pages.labelled_pages(400))

KEPT = [
    ("<p title=it's>Hello there, we don't know it.</p><p>More of it, as it's long.</p>", "Hello there, we don't know it.\nMore of it, as it's long."),
    ('<p>Broken <a href="x>link tail of it.</p>', "Broken link tail of it."),
    ("<article><p>Start of the text.</p><object><p>More text of it in here.</p></article>", "Start of the text.\nMore text of it in here."),
    ("<article><object><p>One text of it.</p><p>Another one.</p><object>no</object></article>", "One text of it.\nAnother one."),
    ("<div><svg></div><p>More text of it.</p>", "More text of it."),
    ("<p>ab<!-- c > d -->cd</p><script>if (a<b) '</p>'</script><p>The end of it.", "abcd\nThe end of it."),
    ("<p>x &#99999999999999999999; y &#x0041; &amp;amp; a < b <3 </p>", "x � y A &amp; a < b <3"),
    ("<p>&#" + "1" * 5000 + ";</p>", "�"),
]


@pytest.mark.parametrize("html, text", KEPT)
def test_malformed_markup_loses_no_text(html, text):
    assert MODEL.text(html) == text


@pytest.mark.parametrize("html", ["", "<", "</", "<!", "<!--", "<a", "<a b", "<a b=", "<a b='", "<script>", "<p", "&#", "\x00", "<svg/><template>"])
def test_cut_off_pages(html):
    assert MODEL.text(html) in ("", "<", "</", "&#", "\x00")


@pytest.mark.parametrize("piece", ["<a b=' ", "\" x", "<b ", "<div></p>", "<!--", "<", "<object>a", "<ul><li><div>", "</p>", "<td><table>", "<a b=\"x>", "&#1", "<svg>", "<script>"])
def test_time_grows_with_the_page(piece):
    took = []
    for size in (100_000, 400_000):
        began = time.process_time()
        MODEL.text("<table><ul>" + piece * (size // len(piece)))
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.5


class _Text(HTMLParser):
    """Words between tags, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


def test_leaves_hold_what_another_parser_reads():
    rng = random.Random(8)
    for _ in range(200):
        pieces = []
        for _ in range(rng.randrange(1, 40)):
            pieces.append(rng.choice(["<p>", "</p>", "<div class='a b'>", "</div>", "<b>", "</b>", "<ul><li>", "</ul>", "text &amp; more ", "it is &eacute; ", "<br>", "<img src=x>", "<script>var a = '<p>';</script>", "<!-- no -->", "a < b ", "<a href=\"/q?a=1&amp;b=2\">", "</a>", "<h2>", "</h2>", "</section>"]))
        html = "".join(pieces)
        other = _Text()
        other.feed(html)
        other.close()
        page = html_text.parse(html)
        assert "".join("".join(t for t in page.text if t is not None).split()) == "".join("".join(other.text).split())


OWN_WORDS = [
    ("""<!doctype html><html><head><title>Harbour news</title></head><body><header class="masthead"><a href="/">Harbour Gazette</a></header>
<nav><ul><li><a href="/local">Local</a></li><li><a href="/sport">Sport</a></li></ul></nav>
<main><article><h1>Ferry returns to the old quay</h1><p>After two winters of repairs, the ferry came back on Monday, and a crowd of two hundred people stood along the wall to greet it.</p>
<aside class="related"><h3>Related</h3><ul><li><a href="/a">Quay to be dredged</a></li></ul></aside>
<p>The harbour master said that the timetable will stay as it was; the last boat leaves at nine.</p></article></main>
<section id="comments"><h3>Comments</h3><div class="comment"><p>About time, if you ask me.</p></div></section>
<footer>&copy; 2024 Harbour Gazette</footer></body></html>""",
     ["Ferry returns to the old quay", "After two winters of repairs, the ferry came back on Monday, and a crowd of two hundred people stood along the wall to greet it.", "The harbour master said that the timetable will stay as it was; the last boat leaves at nine."]),
    ("""<html><body><div id="cookie-consent"><p>We use cookies to make this site better.</p><button>Accept</button></div>
<div class="container"><div class="sidebar"><p>Sign up for our weekly letter.</p></div>
<div class="post-content"><h2>Bread without kneading</h2><p>Mix flour, water, salt and a little yeast, and leave the dough alone until the next morning.</p>
<ul><li>450 g of flour</li><li>350 ml of water</li></ul><p>Bake it in a hot pot for half an hour.</p></div></div></body></html>""",
     ["Bread without kneading", "Mix flour, water, salt and a little yeast, and leave the dough alone until the next morning.", "450 g of flour", "350 ml of water", "Bake it in a hot pot for half an hour."]),
]


_FIRST, _SECOND = "The council met on Tuesday to discuss the new bridge over the river.", "Work is to begin in the spring, and it will last for two years."
OWN_WORDS += [
    # Prose in plain divs, alone and between a bar of links and a line about rights.
    (f"<html><body><div class='css-77'><div>{_FIRST}</div><div>{_SECOND}</div></div></body></html>", [_FIRST, _SECOND]),
    (f"<html><body><div><a href='/a'>Home</a> <a href='/b'>News</a></div><div class='css-77'><div>{_FIRST}</div><div>{_SECOND}</div></div><div>&copy; 2024 Site</div></body></html>", [_FIRST, _SECOND]),
    # A title in the article's own header, while the page's header is none of it.
    (f"<html><body><header class='masthead'><p>Daily Site</p></header><article><header><h1>A new bridge</h1></header><p>{_FIRST}</p><p>{_SECOND}</p></article></body></html>", ["A new bridge", _FIRST, _SECOND]),
    # An article that is a list of links.
    ("<html><body><article><h1>Ten links</h1><ul>" + "".join(f"<li><a href='/{i}'>The story number {i} of the week</a></li>" for i in range(4)) + "</ul></article></body></html>", ["Ten links", *[f"The story number {i} of the week" for i in range(4)]]),
]


@pytest.fixture(scope="module")
def whole_model():
    return html_text.train(labelled_pages.labelled_pages())


@pytest.mark.parametrize("html, blocks", OWN_WORDS)
def test_pages_written_by_hand(html, blocks, whole_model):
    assert whole_model.text(html).split("\n") == blocks


def test_query_counts_code_points(spark, sf_dir, whole_model):
    rows = registry.op5_html_text(spark, sf_dir).collect()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in rows) == sorted((p.page_id, p.url, t, len(t)) for p in pages for t in [whole_model.text(p.html or "")])
