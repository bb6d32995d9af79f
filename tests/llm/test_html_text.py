"""Extraction on pages written for a rule each, and on the given pages against their article elements."""

import html
import random
import re

import pytest

from sluice.llm import html_text as H

WORDS = "words of a paragraph that is long enough to be an article on its own account, surely so. "

CASES = {
    "": "",
    "   <!-- x --> ": "",
    "plain text only": "plain text only",
    "<p>a &amp; b&nbsp;&lt;c&gt;\n  d</p><p></p><p>e": "a & b <c> d e",
    "<script>var t='</p>';</script><p>x<style>p{}</style>y</p>": "xy",
    "<nav><ul><li><a href=x>Menu</a></ul></nav><div class=\"ad\">Buy</div><article><h1>T</h1><p>One.<br>Two.</p></article><footer>&copy; me</footer>": "T One. Two.",
    "<article><h1>T</h1><p><b>Unclosed<br><p>More</p><aside>side</aside><p>End</p>": "T Unclosed More End",
    "<article><header><h1>Title</h1></header><p>Text</p><div class=comments><p>Reader</p></div></article>": "Title Text",
    "<header>Site</header><main><p>Body</p><form><label>Name</label><input></form></main>": "Body",
    "<div id=sidebar>links</div><div><p>" + WORDS + "</p><p>short.</p><p>" + WORDS + "</p></div><div class='cookie-notice'>cookies</div>": (WORDS + "short. " + WORDS).strip(),
    "<ul><li><a>Home</a><li><a>News</a><li><a>Mail</a><li><a>More</a></ul><p>" + WORDS + "<p>© 2024 Owner. All rights reserved.": WORDS.strip(),
    "<p>" + WORDS + "</p><ul>" + "<li><a>link</a></li>" * 5 + "</ul><p>tiny</p>": WORDS.strip(),
    "<p title='a > b'>1 < 2 and <i>3</i>": "1 < 2 and 3",
    "<p hidden>no</p><p style='display: none'>no</p><p>yes</p><p": "yes",
    "<div role=navigation>x</div><p>&#233;&eacute;&bogus;</p>": "éé&bogus;",
    "<p class=ad>ad<p>text": "text",
    "<p class='article-header'>kept</p>": "kept",
    "<td>a<td>b": "a b",
    "<![CDATA[x<y]]>z": "x<yz",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert H.main_text(page) == CASES[page]


ARTICLES = {
    "<article><h1>Short title</h1><aside><p>a<p>b<p>c<p>d</aside><p>" + WORDS + "</p><form><p>a<p>b<p>c</form><h2>End</h2><p>Bye.</p></article>": "Short title " + WORDS + "End Bye.",
    "<article><h1>T</h1>" + "<div class=share>share</div>" * 4 + "<p>" + WORDS + "</article>": "T " + WORDS.strip(),
    '<p title="The hidden valley">a</p><section data-overflow="hidden">b</section><div data-hidden="false">c</div><p data-id="ad-3" title=\'x id="ad"\'>d</p>': "a b c d",
    "<article><h2 id=related-work>a</h2><section id='search-algorithms'><p>b</section><div id=social-history>c</div></article>": "a b c",
    "<article><p>a</p><div id=comments>b</div><div class=related-posts>c</div><div role=search>d</div><p HIDDEN>e</p></article>": "a",
    "<h2 id=related-work>a</h2><p id='x' class='y' style='display:none'>b<p aria-hidden = \"true\">c": "a",
    "<p>Let <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding=tex>x=2</annotation><annotation-xml/></semantics></math> hold": "Let x=2 hold",
}


LONG = "<p>" + WORDS + "</p>"
# Nothing of an article is lost, and what is none goes, inside and beside it.
ARTICLES |= {
    '<article><p>one <svg viewBox="0 0 1 1"/> two</p><p>three</p></article>': "one two three",
    "<article><p>a<svg><g><svg><text>x</text></svg><title>t</title></g></svg>b</p><p>c<svg><path>d</p><p>e</article>": "ab cd e",
    "<article><p>a<template><template>x</template>y</template>b<object><object/>z</object>c<noscript>d</article>": "a bc d",
    "<article><p class='side-effects'>a</p><section class='search-algorithms'>b</section><div class='social-history'>c</div><p class='has-no-widgets'>d</p></article>": "a b c d",
    "<article><p>a</p><div id='comment-17'>x</div><div class='comment-list'>y</div><div class='lead share-buttons'>z</div><p id='adverb'>b</p></article>": "a b",
    "<main><p>a</p><section id='user-comments'><p>x</section></main>": "a",
    "<main>" + LONG + "</main><article><h2>Teaser</h2><p>Read this next.</article>": WORDS.strip(),
    "<main><article>" + LONG + "</article><article><h2>Next</h2></article><p>Below</p></main>": WORDS.strip(),
    "<article>" + LONG + "</article><article>" + LONG + "</article>": (WORDS * 2).strip(),
    "<article><p>a</p><article class=comment><p>x</article><p>b</article>": "a b",
    "<article><p>a<p style='visibility:hidden'>x<p style='display:\n none'>y<p>b</article>": "a b",
    "<article><h1>T</h1><p>tiny</article><p>" + WORDS: "T tiny",
}


@pytest.mark.parametrize("page", ARTICLES)
def test_whole_articles(page):
    assert H.main_text(page) == ARTICLES[page]


def test_stretches():
    assert H.stretches([0, 50, 50, 0, 0, 0, 0, 10, 0]) == [(1, 3)]
    assert H.stretches([0, 5, 0, 0, 0, 9]) == [(5, 6)]
    assert H.stretches([0, 0]) == [] and H.stretches([]) == []


def by_sums(lengths, window, surge):
    """Stretches by their definition: lines of some length, between zeros so wide that a window fits in."""
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))] + [0]
    runs, i = [], 0
    while i < len(sums):
        j = i
        while sums[j]:
            j += 1
        if j > i:
            runs.append((i, j))
        i = j + 1
    best = [r for r in runs if max(sums[r[0] : r[1]]) >= surge]
    if not best and runs:
        best = [max(runs, key=lambda r: sum(lengths[r[0] : r[1]]))]
    out = []
    for a, b in best:
        own = [i for i in range(a, min(len(lengths), b + window)) if lengths[i]]
        out.append((own[0], own[-1] + 1))
    return out


@pytest.mark.parametrize("window", [1, 3, 4])
def test_stretches_by_definition(window):
    rng = random.Random(window)
    for _ in range(300):
        lengths = [rng.choice([0, 0, 0, 5, 40, 200]) for _ in range(rng.randint(0, 30))]
        assert H.stretches(lengths, window, 80) == by_sums(lengths, window, 80)


def test_every_page_goes_through_the_sums(monkeypatch):
    seen, plain_stretches = [], H.stretches
    monkeypatch.setattr(H, "stretches", lambda *a, **k: seen.append(a) or plain_stretches(*a, **k))
    for page in ("<article><p>a</article>", "<main>b</main>", "<p>c", ""):
        H.main_text(page)
    assert len(seen) == 4


def test_pages_without_an_article():
    """The article of a page without such an element, between menus, links, notices and rights."""
    menu = "<ul>" + "<li><a href=x>Item</a></li>" * 6 + "</ul>"
    body = "".join(f"<p>{WORDS}{i}</p>" for i in range(5))
    page = f"<div class=top-nav>{menu}</div><h1>Title</h1>{body}<div class='related'>{menu}</div><p>© 2024 Owner. All rights reserved."
    assert H.main_text(page) == "Title " + " ".join(f"{WORDS}{i}" for i in range(5))


def test_odd_pages_end():
    for page in ("<" * 50_000, "<p " * 20_000, "<a href='" * 5_000, "<!--" * 9, "&" * 9999, "<div>" * 20_000 + "deep", "</div>" * 1000, "<svg>" * 3000, "<template>" * 3000, "<noscript>" * 3000):
        H.main_text(page)


def plain(page):
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
    blocks = re.split(r"<(?:/?p|/?h1|br)>", inner)
    return " ".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if t)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = {r["page_id"]: r for r in H.extracted(pages).collect()}
    for r in pages.collect():
        assert texts[r["page_id"]]["text"] == plain(r["html"]) and texts[r["page_id"]]["n_chars"] == len(plain(r["html"]))


def test_rows(spark):
    rows = [(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<p>x", None)]
    found = H.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1)], key=repr)
    assert H.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
