import pytest

from dialmesh.functions import urls

GOOD = {
    "https://fr.library.example": ("https://fr.library.example", "https", "fr.library.example"),
    "http://under_score.example": ("http://under_score.example", "http", "under_score.example"),
    "shop.example": ("https://shop.example", "https", "shop.example"),
    "  shop.example\t": ("https://shop.example", "https", "shop.example"),
    " shop.example　": ("https://shop.example", "https", "shop.example"),
    "HTTPS://Shop.example/A": ("https://Shop.example/A", "https", "Shop.example"),
    "https://a.example:8080/x?y=1#z": ("https://a.example:8080/x?y=1#z", "https", "a.example"),
    "https://a.example:/x": ("https://a.example:/x", "https", "a.example"),
    "https://[::1]:80/": ("https://[::1]:80/", "https", "::1"),
    "https://u:p@a.example/": ("https://u:p@a.example/", "https", "a.example"),
    "https://a.example/b c": ("https://a.example/b%20c", "https", "a.example"),
    "https://a.example/é#": ("https://a.example/%C3%A9", "https", "a.example"),
    "https://a.example?q=http://b": ("https://a.example?q=http://b", "https", "a.example"),
    "https://a.example/x?": ("https://a.example/x?", "https", "a.example"),
}
BAD = {
    "": "missing_host",
    "   ": "missing_host",
    "https://": "missing_host",
    "https:///path": "missing_host",
    "shop.example/?u=http://x": "missing_host",
    "https://fr library dot example": "invalid_url",
    "not quite a line": "invalid_url",
    "https://a.example:port": "invalid_url",
    "https://a.example/%zz": "invalid_url",
    "https://a.example/#%q": "invalid_url",
    "https://a.exa\x01mple": "invalid_url",
    "https://a%20b.example": "invalid_url",
    "https://u ser@a.example": "invalid_url",
    "https://[::1/": "invalid_url",
    "://a.example": "invalid_url",
    "ht_tp://a.example": "invalid_url",
    "redis://cache.example": "invalid_scheme",
    "//a.example?u=://": "invalid_scheme",
}


def test_good_urls(column):
    out = column(GOOD, urls.parse_url_checked)
    assert [(r["url"], r["scheme"], r["hostname"]) for r in out] == list(GOOD.values())
    assert all(r["error"] is None for r in out)


def test_bad_urls(column):
    out = column(BAD, urls.parse_url_checked)
    assert [r["error"] for r in out] == list(BAD.values())
    assert all(r["url"] is None and r["host"] is None for r in out)


def test_null_url(column):
    assert column([None], urls.parse_url_checked)[0]["error"] == "missing_host"


def test_plain_urls_take_no_other_way(column, monkeypatch):
    """The short way for plain addresses gives what the full checks give."""
    cases = list(GOOD) + list(BAD) + ["http://a.example:1/x;y=1?z={}|", "a..example", "-", "https://-/"]
    short = column(cases, urls.parse_url_checked)
    monkeypatch.setattr(urls, "_PLAIN", r"^\b$")
    assert column(cases, urls.parse_url_checked) == short


def test_company_id(column):
    assert column(["https://a.example:8080/x", "b.example", "bad host"], urls.company_id) == [
        "a.example",
        "b.example",
        None,
    ]


@pytest.mark.parametrize(
    "seed, host, allowed",
    [
        ("a.example", "a.example", True),
        ("a.example", "www.a.example", True),
        ("www.a.example", "www.www.a.example", True),
        ("www.a.example", "a.example", False),
        ("a.example", "b.example", False),
        ("a.example", "a.example:80", False),
    ],
)
def test_allowed_host(column, seed, host, allowed):
    from pyspark.sql import functions as F

    assert column([host], lambda c: urls.allowed_host(c, F.lit(seed))) == [allowed]


def test_robots_url(column):
    given = ["https://a.example", "https://a.example:1/x/y?q=1#z", "http://u@a.example/é"]
    assert column(given, urls.robots_url) == [
        "https://a.example/robots.txt",
        "https://a.example:1/robots.txt?q=1",
        "http://u@a.example/robots.txt",
    ]


def test_visit_url(column):
    given = ["https://a.example/x", "//a.example/x", "/x", "", "https://a.example/é", "https://a b/", "tel:1"]
    assert column(given, urls.visit_url) == [
        "https://a.example/x",
        "http://a.example/x",
        "/x",
        "",
        "https://a.example/%C3%A9",
        None,
        "tel:1",
    ]
