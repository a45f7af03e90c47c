import random

import pytest
from pyspark.sql import functions as F

from dialmesh import joins
from dialmesh.operators import crawl as ops
from dialmesh.operators.companies import STORE_SCHEMA
from dialmesh.plans.scrape import scrape_companies
from dialmesh.sources.captures import CAPTURE_SCHEMA


def page(links, text=""):
    return "<body>" + text + "<nav>" + "".join(f'<a href="{u}">x</a>' for u in links) + "</nav></body>"


def run(spark, seeds, captures):
    seeds = spark.createDataFrame([(s,) for s in seeds], "url string")
    return ops.crawl_sites(seeds, spark.createDataFrame(captures, CAPTURE_SCHEMA))


@pytest.mark.parametrize("links, found", [
    (["/wild", "/pics", "/contact-us", "/shop", "/about"], "/contact-us"),
    (["/wild", "/Contact", "/shop", "/about", "/about-2"], "/about"),
    (["/wild", "/pics"], "/wild"),
    (["/about-contact", "/contact"], "/about-contact"),
    ([], None),
])
def test_next_link(spark, links, found):
    df = spark.createDataFrame([(links,)], "q array<string>")
    assert df.select(ops.next_link("q")).first()[0] == found


def test_known_cases(spark):
    base = "https://r.example"
    menu = [base + p for p in ("/", "/about/", "/contact/", "/links/", "/recs/", "/acts/", "/hotels/", "/dining/")]
    many = [f"https://m.example/{i}" for i in range(20)]
    captures = [(base, 200, None, page(menu))] + [(u, 200, None, page(menu)) for u in menu]
    captures += [("https://m.example", 200, None, page(many))] + [(u, 200, None, page(many)) for u in many]
    captures += [
        ("https://p.example", 200, None, page(["https://p.example/contact"], "call 541-754-3010")),
        ("https://p.example/contact", 200, None, page([], "541-754-3011")),
        ("https://i.example", 200, None, page([], "call 555-555-5555")),
        ("https://g.example", 200, None, page(["https://g.example/contact", "https://g.example/about"])),
        ("https://g.example/about", 200, None, page([], "541-754-3010")),
        ("https://rel.example", 200, None, page(["/about"])),
        ("https://rel.example/about", 200, None, page([], "541-754-3010")),
        ("https://off.example", 200, None, page(["https://p.example"])),
        ("https://w.example", 200, None, page(["//www.w.example/x"])),
        ("http://www.w.example/x#top", 200, None, "<body><a href='tel:(541) 754-3010'></a>"),
        ("https://f.example", 500, None, page([], "541-754-3010")),
        ("https://t.example", 200, "timeout", page([], "541-754-3010")),
        ("https://self.example", 200, None, page(["https://self.example", "https://self.example/b"])),
        ("https://self.example/b", 200, None, page([], "541-754-3010")),
    ]
    names = "r m p i g rel off w f t self none".split()
    crawl = run(spark, [f"https://{n}.example" for n in names] + ["bad url"], captures)
    sites = {r["seed"]: r for r in crawl.sites.collect()}
    visits = {n: [u for u in sites[f"https://{n}.example"]["links_visited"]] for n in names}
    assert visits["r"] == [base] + [base + p for p in (
        "/contact/", "/about/", "/", "/links/", "/recs/", "/acts/", "/hotels/", "/dining/")]
    assert visits["m"] == ["https://m.example"] + many[:10]
    assert visits["p"] == ["https://p.example"] and visits["i"] == ["https://i.example"]
    assert visits["g"] == ["https://g.example"]  # the contact page was not captured
    assert visits["rel"] == ["https://rel.example"] and visits["off"] == ["https://off.example"]
    assert visits["w"] == ["https://w.example", "http://www.w.example/x"]
    assert visits["self"] == ["https://self.example"]
    errors = {n: sites[f"https://{n}.example"]["error"] for n in names}
    assert {n: e for n, e in errors.items() if e} == {"f": "status_500", "t": "timeout", "none": "not_captured"}
    assert sites["bad url"]["error"] == "invalid_url"
    phones = {(r["seed"], r["number"], r["confidence"]) for r in crawl.phones().collect()}
    assert phones == {("https://p.example", "+1 541-754-3010", 0), ("https://w.example", "+1 541-754-3010", 2)}
    assert tuple(crawl.stats().first()) == (13, 4, 2)


def by_hand(seeds, pages):
    """One site at a time, as a plain loop."""
    out = {}
    for seed in seeds:
        host = seed.split("/")[2]
        visited, links, seen, phones, link = [], [], set(), [], seed
        while link is not None:
            ok = link.split("/")[2:3] in ([host], ["www." + host]) and link not in visited and link in pages
            if not ok:
                break
            visited.append(link)
            found, hrefs = pages[link]
            phones += found
            for h in hrefs:
                if h not in seen:
                    seen.add(h)
                    links.append(h)
            link = None
            if not phones and len(visited) <= 10 and links:
                link = next((u for w in ("contact", "about") for u in links if w in u), links[0])
                links.remove(link)
        out[seed] = (visited, phones)
    return out


@pytest.mark.parametrize("bits, hot", [(16, 1_000_000), (0, 2)])
def test_random_sites_against_a_loop(spark, bits, hot, monkeypatch):
    """With room in the filter of hosts and with one full block for all, and with hot keys
    (pages that many seeds want at once) split off."""
    monkeypatch.setattr(joins, "KEY_BITS", bits)
    monkeypatch.setattr(joins, "HOT_ROWS", hot)
    rng = random.Random(7)
    pages, seeds = {}, []
    for s in range(40):
        host = f"s{s}.example"
        names = ["", "/contact", "/about", "/about-contact"] + [f"/{i}" for i in range(12)]
        urls = [f"https://{rng.choice(['', '', 'www.'])}{host}{n}" for n in names]
        urls[0] = f"https://{host}"
        seeds.append(urls[0])
        targets = urls + ["/rel", "https://else.example/", "mailto:x", "", f"https://{host}/gone"]
        for u in urls:
            if rng.random() < 0.93:
                links = [rng.choice(urls if rng.random() < 0.95 else targets) for _ in range(rng.randint(0, 6))]
                pages[u] = (["541-754-3010"] if rng.random() < 0.06 else [], links)
    captures = [(u, 200, None, page(links, " ".join(p))) for u, (p, links) in pages.items()]
    # A third of all seeds lies on one host and soon asks for the same pages.
    crowd = [f"https://s0.example/in/{i}" for i in range(20)]
    for u in crowd:
        pages[u] = ([], ["https://s0.example/contact"])
    pages.setdefault("https://s0.example/contact", ([], ["https://s0.example/about"]))
    seeds += crowd
    captures = [(u, 200, None, page(links, " ".join(p))) for u, (p, links) in pages.items()]
    crawl = run(spark, seeds, captures)
    got = {r["seed"]: (r["links_visited"], [p["number"] for p in r["phones"]]) for r in crawl.sites.collect()}
    assert got == by_hand(seeds, pages)
    assert max(len(v) for v, _ in got.values()) == 11


def test_empty_inputs(spark):
    none = spark.createDataFrame([], CAPTURE_SCHEMA)
    assert ops.crawl_sites(spark.createDataFrame([], "url string"), none).sites.isEmpty()
    one = ops.crawl_sites(spark.createDataFrame([("https://a.example",)], "url string"), none)
    assert [r["error"] for r in one.sites.collect()] == ["not_captured"]


def test_copies_of_a_capture_count_once(spark):
    good = ("https://a.example", 200, None, page([], "541-754-3010"))
    captures = [good] * 50 + [("https://a.example", 503, None, page([], "212-754-3010"))] * 50
    crawl = run(spark, ["https://a.example", "https://a.example"], captures)
    assert crawl.sites.count() == 2
    assert [r["number"] for r in crawl.phones().collect()] == ["+1 541-754-3010"]


def test_scrape_into_the_store(spark):
    captures = [("https://a.example", 200, None, page([], "541-754-3010 5417543011 541.754.3010")),
                ("https://b.example", 200, None, page([], "none")),
                ("https://z.example", 200, None, page([], "541-754-3010"))]
    store = spark.createDataFrame(
        [("a.example", "https://a.example", "A", "", ["A"], ["old"]), ("b.example", "https://b.example", "B", "", [], ["old"])],
        STORE_SCHEMA)
    seeds = spark.createDataFrame([(f"https://{n}.example",) for n in "abz"], "url string")
    out = scrape_companies(store, seeds, spark.createDataFrame(captures, CAPTURE_SCHEMA))
    phones = {r["id"]: r["phone_numbers"] for r in out.result.store.collect()}
    assert phones == {"a.example": ["+1 541-754-3010", "+1 541-754-3011"], "b.example": ["old"]}
    assert [tuple(r) for r in out.result.rejects.collect()] == [("https://z.example", "not_found")]
    assert out.updates.select(F.size("phone_numbers")).agg(F.sum("size(phone_numbers)")).first()[0] == 3
