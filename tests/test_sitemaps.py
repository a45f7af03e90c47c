import random

from pyspark.sql import functions as F

from dialmesh.operators import sitemaps as ops
from dialmesh.sources.captures import CAPTURE_SCHEMA

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<?xml-stylesheet type="text/xsl" href="a.xsl" ?>\n'
NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def urlset(*locs):
    return HEAD + f"<urlset {NS}>\n" + "".join(f"  <url>\n <loc>{u}</loc><x/></url>\n" for u in locs) + "</urlset>"


def index(*locs):
    return HEAD + f"<sitemapindex {NS}>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in locs) + "</sitemapindex>"


def test_robots(column):
    rules = "User-agent: *\nDisallow: /x\nAllow: /x/y\n\n"
    bodies = {
        rules + "Sitemap: https://a.example/map.xml": ("https://a.example/map.xml", None),
        rules.replace("\n", "\r\n") + "\tSitemap:https://a.example/é.xml \r\nmore": ("https://a.example/%C3%A9.xml", None),
        rules: (None, "not_found"),
        "": (None, "not_found"),
        "sitemap: https://a.example/map.xml": (None, "not_found"),
        "x Sitemap: https://a.example/map.xml": (None, "not_found"),
        "Sitemap: not at all valid\nSitemap: https://a.example/map.xml": (None, "invalid_url"),
        "Sitemap: /map.xml": (None, "invalid_url"),
        "Sitemap:": (None, "invalid_url"),
        "Sitemap: ftp://a.example/map.xml": ("ftp://a.example/map.xml", None),
    }
    out = column(bodies, lambda c: ops.sitemap_from_robots(F.col(c)))
    assert [(r["url"], r["error"]) for r in out] == list(bodies.values())


def test_entries(column):
    bodies = {
        urlset("https://a/1", "https://a/2?x=1&amp;y=2"): (["https://a/1", "https://a/2?x=1&y=2"], []),
        urlset("https://a/1"): (["https://a/1"], []),
        urlset(): ([], []),
        index("https://a/s.xml", "https://a/t.xml"): ([], ["https://a/s.xml", "https://a/t.xml"]),
        f"<!-- c --><urlset {NS}><sitemap><loc>no</loc></sitemap><url><loc><![CDATA[https://a/1]]></loc></url></urlset>": (
            ["https://a/1"], []),
        "<other><url><loc>x</loc></url></other>": ([], []),
        "<urlset><url><loc>x</loc>": ([], []),
        "<html><p>not xml": ([], []),
        "": ([], []),
    }
    out = column(bodies, lambda c: ops.sitemap_entries(F.col(c)))
    assert [(r["locs"], r["sitemaps"]) for r in out] == list(bodies.values())


def test_sites(spark):
    captures = [
        ("https://a.example/robots.txt", 404, None, "Sitemap: https://a.example/i.xml"),
        ("https://a.example/i.xml", 200, None, index(
            "https://a.example/1.xml", "https://b.example/b.xml", "https://a.example/gone.xml",
            "https://a.example/broken.xml", "https://www.a.example/2.xml", "https://a.example/failed.xml")),
        ("https://a.example/1.xml", 200, None, urlset("https://a.example/z", "https://a.example/y")),
        ("https://www.a.example/2.xml", 200, None, urlset("https://a.example/x")),
        ("https://a.example/broken.xml", 200, None, "<urlset><url><loc>https://a.example/n"),
        ("https://a.example/failed.xml", 500, None, urlset("https://a.example/n")),
        ("https://b.example/b.xml", 200, None, urlset("https://b.example/n")),
        ("https://b.example/robots.txt", 200, None, "nothing"),
        ("https://c.example/robots.txt", 200, "reset", "Sitemap: https://c.example/i.xml"),
        ("https://d.example/robots.txt", 200, None, "Sitemap: https://d.example/none.xml"),
    ]
    sites = spark.createDataFrame([(f"https://{n}.example",) for n in "abcde"], "url string")
    links, status = ops.sitemap_links(sites, spark.createDataFrame(captures, CAPTURE_SCHEMA))
    assert [r["link"] for r in links.orderBy("url", "path", "pos").collect()] == [
        "https://a.example/z", "https://a.example/y", "https://a.example/x"]
    assert {r["url"][8]: r["error"] for r in status.collect()} == {
        "a": None, "b": "not_found", "c": "reset", "d": "not_captured", "e": "not_captured"}


def by_hand(root, nodes):
    seen, out = set(), []

    def visit(url):
        if url in seen:
            return
        seen.add(url)
        if url in nodes:
            kind, locs = nodes[url]
            if kind == "urlset":
                out.extend(locs)
            else:
                for u in locs:
                    visit(u)

    visit(root)
    return out


def test_random_indexes_against_a_walk(spark):
    """Shared, repeated and circular indexes come out in depth-first order."""
    rng = random.Random(3)
    captures, roots, want = [], [], {}
    for s in range(25):
        host = f"https://h{s}.example"
        urls = [f"{host}/{i}.xml" for i in range(9)]
        nodes = {}
        for i, u in enumerate(urls[:8]):
            if i < 5:
                nodes[u] = ("index", [rng.choice(urls) for _ in range(rng.randint(1, 4))])
            else:
                nodes[u] = ("urlset", [f"{host}/page/{i}/{k}" for k in range(rng.randint(0, 3))])
        captures += [(u, 200, None, urlset(*locs) if kind == "urlset" else index(*locs)) for u, (kind, locs) in nodes.items()]
        roots.append((host, urls[0]))
        want[host] = by_hand(urls[0], nodes)
    links = ops.expand_sitemaps(
        spark.createDataFrame(roots, "url string, sitemap_url string"), spark.createDataFrame(captures, CAPTURE_SCHEMA))
    got = {host: [] for host, _ in roots}
    for r in links.orderBy("url", "path", "pos").collect():
        got[r["url"]].append(r["link"])
    assert got == want


def test_no_body_is_shuffled(spark):
    captures = spark.createDataFrame([], "url string, status int, error string, body string")
    plan = ops._parsed_sitemaps(captures)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "HashAggregate" in line or "SortAggregate" in line or "Exchange" in line]
    assert moved and not any("body" in line for line in moved)
