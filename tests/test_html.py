import random
import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialmesh.functions import html

TEXT = {
    "<html><head><title>t</title><script>x</script></head><body>a</body></html>": "a",
    "no markup": "no markup",
    "<title>t</title>body<title>in body</title>": "bodyin body",
    "<body>541<td>754</td><td>3010</td>": "5417543010",
    "<body>a<script>var t='</p><b>';</script>b<style>c{}</style>d": "abd",
    "<body>a<SCRIPT type='x>y'>if (a<b) {}</Script >b": "ab",
    "<body>a<script>never closed": "a",
    "<body>a<!-- <p>comment</p> -->b<!-->c<!-- open": "abc",
    "<body>a<!DOCTYPE x>b<?php echo ?>c</ z>d</>e": "abcde",
    "<body>a < b <3 a<b": "a < b <3 a",
    "<body>a<p title='x>y' data-a=\"</p>\">b</p>c": "abc",
    "<body>a<img alt='it's' src=x>b": "ab",
    "<body>&lt;b&gt; &amp;amp; &quot;&copy;&nbsp;&middot;": '<b> &amp; "© ·',
    "<body>&amp &am &ampx &notit; &unknown; &#65;&#x42;&#67 &#128; &#0; &#x110000; &#x1F600;": (
        "& &am &x ¬it; &unknown; ABC € � � 😀"
    ),
    "<body>&am<b>p;</b>&<i>amp;</i>": "&amp;&amp;",
    "<body><noscript><a href=x>&amp;</a></noscript>|<textarea><b>&amp;</textarea>|<iframe><p>&lt;</iframe>": (
        "<a href=x>&amp;</a>|<b>&|<p>&lt;"
    ),
    "": "",
}


def test_body_text(column):
    out = column(TEXT, html.body_text)
    for page, got in zip(TEXT, out):
        assert got == TEXT[page], page


LINKS = {
    "<nav><a href='/a'>x</a><a href=\" /b \">y</a></nav><a href=/c>": (["/a", " /b ", "/c"], ["/a", " /b "]),
    "<nav><a href=1><nav><a href=2></nav><a href=3></nav><a href=4>": (["1", "2", "3", "4"], ["1", "2", "3", "2"]),
    "<nav><a href=1><a href=1></nav>": (["1", "1"], ["1", "1"]),
    "<a name=x><a data-href=no HREF=yes><a title='href=no'><a href><a href=''>": (["yes", "", ""], []),
    "<a href='x' href='y'><abbr href=no><A\nHREF='z'\n>": (["x", "z"], []),
    "<nav>x<!-- <a href=no> --><script>'<a href=no>'</script><a href=ok></nav>": (["ok"], ["ok"]),
    "<textarea><a href=no></textarea><p title='<a href=no>'><a href=ok": ([], []),
    "<NAV class=a><a href='?a=1&amp;b=2&copy=3&lt'></NAV></nav><nav><a href=2>": (
        ["?a=1&b=2&copy=3<", "2"], ["?a=1&b=2&copy=3<", "2"]),
    "<navbar><a href=1></navbar><nav></nav>": (["1"], []),
    "<nav/><a href=1></nav><a href=2>": (["1", "2"], ["1"]),
    "</nav><a href=0><nav><a href=1><a href=2></nav><a href=3></nav><nav><a href=4>": (
        ["0", "1", "2", "3", "4"], ["1", "2", "4"]),
    "<a href=0></nav></nav><nav><nav></nav><a href=1></nav><a href=2><nav><a href=3></nav>": (
        ["0", "1", "2", "3"], ["1", "3"]),
    "<a href=0><a href=1>": (["0", "1"], []),
}


def test_links(column):
    tags = column(LINKS, lambda c: html.hrefs_in_body(html.link_tags(c)))
    navs = column(LINKS, lambda c: html.hrefs_in_nav(html.link_tags(c)))
    for page, body, nav in zip(LINKS, tags, navs):
        assert (body, nav) == LINKS[page], page


class Reader(HTMLParser):
    """Independent check for pages without odd markup."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.text, self.links, self.nav, self.skip, self.depth = [], [], [], 0, 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        self.depth += tag == "nav"
        href = dict(reversed(attrs)).get("href")
        if tag == "a" and href is not None:
            self.links.append(href)
            if self.depth:
                self.nav.append(href)

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")
        self.depth -= tag == "nav" and self.depth > 0

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


PIECES = ["<p>", "</p>", "<b class='x>'>", "</b>", "<nav>", "</nav>", "<a href='/x'>", '<a class=k href="/y?a=1&amp;b">',
          "</a>", "<script>var a = '<b>';</script>", "<style>p{}</style>", "<!-- <a href=n> -->", "&amp;", "&lt;",
          "&#233;", "text ", "541-754-3010", "\n", "é", "<br/>", "1 > 0"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), min_size=30, max_size=30))
def test_against_a_parser(column, bodies):
    pages = [f"<html><head><title>t</title></head><body>{b}</body></html>" for b in bodies]
    read = [Reader("<body>" + b + "</body>") for b in bodies]
    assert column(pages, html.body_text) == ["".join(r.text) for r in read]
    assert column(pages, lambda c: html.hrefs_in_body(html.link_tags(c))) == [r.links for r in read]
    single = [i for i, b in enumerate(bodies) if "<nav>" not in b.split("<nav>", 1)[-1].split("</nav>", 1)[0]]
    navs = column(pages, lambda c: html.hrefs_in_nav(html.link_tags(c)))
    flat = [i for i in single if b_is_flat(bodies[i])]
    assert [navs[i] for i in flat] == [read[i].nav for i in flat]


def b_is_flat(body):
    depth = 0
    for piece in body.replace("</nav>", "\0)").replace("<nav>", "\0(").split("\0")[1:]:
        depth = depth + 1 if piece[0] == "(" else max(depth - 1, 0)
        if depth > 1:
            return False
    return True


def test_given_pages_against_a_parser(spark):
    path = "/root/testdata/sf0.001/pages.parquet"
    pages = pq.read_table(path).to_pydict()
    df = spark.read.parquet(path).select(
        "page_id", html.body_text("html").alias("t"), html.hrefs_in_nav(html.link_tags("html")).alias("n")
    )
    got = {r["page_id"]: (r["t"], r["n"]) for r in df.collect()}
    for page_id, page in zip(pages["page_id"], pages["html"]):
        read = Reader(page[page.index("<body>"):])
        assert got[page_id] == ("".join(read.text), read.nav)


def test_long_pages(spark):
    """Many navs, links and numbers on one page."""
    from dialmesh.operators.page_features import page_features

    page = "<nav><a href=1></a></nav>" * 20_000 + "call 541-754-3010, " * 20_000
    row = page_features(spark.createDataFrame([(page,)], "body string")).first()
    assert (len(row["nav"]), len(row["phones"])) == (20_000, 20_000)


@pytest.mark.parametrize("page", ["<" * 100_000, "<p " * 50_000, "<a href='" * 30_000, "<!--" * 50_000,
                                  "<script>" * 20_000, "&" * 100_000, "<p a=" + "\"" * 50_001])
def test_hostile_pages_stay_linear(column, page):
    """No backtracking stack and no quadratic scan."""
    column([page], html.body_text)
    column([page], lambda c: html.hrefs_in_nav(html.link_tags(c)))


def test_random_navs_against_a_stack(column):
    rng, pages, want = random.Random(4), [], []
    for _ in range(200):
        items = [(rng.choice([1, -1, 0, 0]), f"/{i}") for i in range(rng.randrange(40))]
        pages.append("".join({1: "<nav>", -1: "</nav>", 0: f'<a href="{h}">x</a>'}[k] for k, h in items))
        opened, spans = [], []
        for at, (kind, _) in enumerate(items):
            if kind == 1:
                opened.append(len(spans))
                spans.append([at, len(items)])
            elif kind == -1 and opened:
                spans[opened.pop()][1] = at
        want.append([h for a, b in spans for k, h in items[a:b] if k == 0])
    assert column(pages, lambda c: html.hrefs_in_nav(html.link_tags(c))) == want


def test_deep_navs_cost_no_more_than_their_tags(column):
    def seconds(n):
        page = "<nav>" * n + '<a href="/x">x</a>' + "</nav>" * n
        start = time.perf_counter()
        assert column([page], lambda c: F.size(html.hrefs_in_nav(html.link_tags(c)))) == [n]
        return time.perf_counter() - start

    seconds(2000)
    assert seconds(16_000) < 8 * seconds(2000) + 4
