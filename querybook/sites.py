"""Crawl, sitemaps and the stream.

The links inside the given pages lead nowhere, so sites are derived: sixteen
consecutive pages form one, each page keeps its text and gets a nav with the
addresses of all sixteen.  The visit order then has a closed form.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from dialmesh.functions.html import hrefs_in_nav, link_tags
from dialmesh.operators.crawl import crawl_sites, next_link, phones_to_company, within_page_limit
from dialmesh.operators.sitemaps import (
    expand_sitemaps,
    robots_sitemaps,
    sitemap_from_robots,
    sitemap_links,
    sitemap_locs,
)
from dialmesh.plans.scrape import scrape_companies
from dialmesh.session import scratch_dir
from dialmesh.sources.captures import load_captures, stream_captures
from dialmesh.sources.company_store import CompanyStore
from dialmesh.streaming.scrape_stream import (
    apply_log,
    merge_batch,
    read_log,
    start_scrape_stream,
    start_store_stream,
)

from .base import query, table
from .pages import page_phone_rows, sql_text
from .phones import PATTERN, validated

# --- derived sites -----------------------------------------------------------
# Slot 0 is the seed, slot 5 the contact page, slot 9 the about page.
_PATH = """CASE WHEN {slot} = 0 THEN '' WHEN {slot} = 5 THEN '/contact' WHEN {slot} = 9 THEN '/about'
           ELSE '/p' || ({slot}) END"""
_SITE = "'https://s' || CAST(floor(page_id / 16) AS bigint) || '.example'"
_STATUS = "CASE WHEN page_id % 41 = 11 THEN 500 ELSE 200 END"
_ERROR = "CASE WHEN page_id % 53 = 12 THEN 'timeout' END"
_NAV = f"""'<nav>' || concat_ws('', transform(sequence(0, 15), s ->
           '<a href="' || {_SITE} || {_PATH.format(slot='s')} || '">x</a>')) || '</nav>'"""


def site_captures(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr(
        f"{_SITE} || {_PATH.format(slot='page_id % 16')} AS url",
        f"{_STATUS} AS status",
        f"{_ERROR} AS error",
        f"regexp_replace(html, '(?s)<nav>.*?</nav>', '') || {_NAV} AS body",
    )


def site_seeds(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr(f"{_SITE} AS url").distinct()


# Visit order of a site's pages: seed, contact, about, then the other slots; the
# link to slot 0 is the seed's own address, which ends the crawl when its turn comes.
_SLOT = "page_id % 16"
_ORDER = f"""CASE {_SLOT} WHEN 0 THEN 0 WHEN 5 THEN 1 WHEN 9 THEN 2 ELSE NULL END"""
_VISITS = f"""
  SELECT seed, url, step, failed, has_phone, page_id, html FROM (
    SELECT {_SITE} AS seed, {_SITE} || {_PATH.format(slot=_SLOT)} AS url, {_ORDER} AS step,
           {_STATUS} <> 200 OR ({_ERROR}) IS NOT NULL AS failed, page_id, html,
           len(regexp_extract_all({sql_text("regexp_replace(html, '(?s)<nav>.*?</nav>', '')")}, '{PATTERN}')) > 0
             AS has_phone
    FROM pages
  ) WHERE step IS NOT NULL
"""
# A step happens when every earlier one succeeded without finding a number.
_SEEN = f"""
  SELECT * FROM (
    SELECT *, coalesce(bool_or(failed OR has_phone) OVER (
      PARTITION BY seed ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over
    FROM ({_VISITS})
  ) WHERE NOT over
"""


@query("links_visited", f"SELECT seed, step, url FROM ({_SEEN}) WHERE NOT failed")
def links_visited_query(spark, sf_dir):
    return crawl_sites(site_seeds(spark, sf_dir), site_captures(spark, sf_dir)).links_visited()


@query(
    "crawl_domain",
    f"""
    SELECT s.seed, CASE WHEN s.error IS NOT NULL THEN s.error END AS error,
           coalesce(v.n, 0) AS visits, coalesce(v.last_url, '') AS last_url
    FROM (SELECT {_SITE} AS seed,
                 CASE WHEN ({_ERROR}) IS NOT NULL THEN {_ERROR} WHEN {_STATUS} <> 200 THEN 'status_500' END AS error
          FROM pages WHERE page_id % 16 = 0) s
    LEFT JOIN (SELECT seed, count(*) AS n, arg_max(url, step) AS last_url
               FROM ({_SEEN}) WHERE NOT failed GROUP BY seed) v ON v.seed = s.seed
    """,
)
def crawl_domain_query(spark, sf_dir):
    sites = crawl_sites(site_seeds(spark, sf_dir), site_captures(spark, sf_dir)).sites
    return sites.select(
        "seed",
        "error",
        F.size("links_visited").alias("visits"),
        F.coalesce(F.try_element_at("links_visited", F.lit(-1)), F.lit("")).alias("last_url"),
    )


# Captures without status and errors, and a nav without the seed: eleven visits.
_LONG_PATH = "'/q' || ({slot})"
_LONG_NAV = f"""'<nav>' || concat_ws('', transform(sequence(1, 15), s ->
                '<a href="' || {_SITE} || {_LONG_PATH.format(slot='s')} || '">x</a>')) || '</nav>'"""
_LONG_HTML = "regexp_replace(html, '(?s)<nav>.*?</nav>', '')"
_LONG_VISITS = f"""
  SELECT * FROM (
    SELECT *, coalesce(bool_or(has_phone) OVER (
      PARTITION BY seed ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over
    FROM (
      SELECT {_SITE} AS seed, {_SLOT} AS step, page_id, html,
             {_SITE} || CASE WHEN {_SLOT} = 0 THEN '' ELSE {_LONG_PATH.format(slot=_SLOT)} END AS url,
             len(regexp_extract_all({sql_text(_LONG_HTML)}, '{PATTERN}')) > 0 AS has_phone
      FROM pages WHERE {_SLOT} < 11
    )
  ) WHERE NOT over
"""


def long_captures(spark, sf_dir):
    slot = "page_id % 16"
    return table(spark, sf_dir, "pages").selectExpr(
        f"{_SITE} || CASE WHEN {slot} = 0 THEN '' ELSE {_LONG_PATH.format(slot=slot)} END AS url",
        "200 AS status",
        "cast(null AS string) AS error",
        f"{_LONG_HTML} || {_LONG_NAV} AS body",
    )


def long_crawl(spark, sf_dir):
    return crawl_sites(site_seeds(spark, sf_dir), long_captures(spark, sf_dir))


@query("page_limit", f"SELECT seed, count(*) AS visits, count(*) < 11 AS room FROM ({_LONG_VISITS}) GROUP BY seed")
def page_limit_query(spark, sf_dir):
    return long_crawl(spark, sf_dir).sites.select(
        "seed", F.size("links_visited").alias("visits"), within_page_limit("links_visited").alias("room")
    )


_LONG_ROWS = page_phone_rows(
    f"(SELECT page_id, seed AS url, {_LONG_HTML} AS html FROM ({_LONG_VISITS}))", tel=False
)
_LONG_PHONES = f"""
  SELECT url AS seed, number, max(confidence) AS confidence, min(pos) AS pos
  FROM (SELECT url, pos, valid_number AS number, confidence
        FROM ({validated(_LONG_ROWS)}) WHERE error IS NULL)
  GROUP BY url, number
"""


@query("crawl_domains", _LONG_PHONES)
def crawl_domains_query(spark, sf_dir):
    return long_crawl(spark, sf_dir).phones()


@query(
    "crawl_stats",
    f"""
    SELECT (SELECT count(DISTINCT {_SITE}) FROM pages) AS seeds, 0 AS failed_seeds,
           (SELECT count(DISTINCT seed) FROM ({_LONG_PHONES})) AS seeds_with_phones
    """,
)
def crawl_stats_query(spark, sf_dir):
    return long_crawl(spark, sf_dir).stats()


_NUMBERS = f"SELECT seed AS url, list(number ORDER BY pos) AS phone_numbers FROM ({_LONG_PHONES}) GROUP BY seed"


@query("phones_to_company", _NUMBERS, lists=("phone_numbers",))
def phones_to_company_query(spark, sf_dir):
    return phones_to_company(long_crawl(spark, sf_dir).phones())


@query(
    "scrape_companies",
    f"""
    SELECT 's' || s_suppkey || '.example' AS id, s_name AS commercial_name, n.phone_numbers
    FROM supplier LEFT JOIN ({_NUMBERS}) n ON n.url = 'https://s' || s_suppkey || '.example'
    """,
    lists=("phone_numbers",),
)
def scrape_companies_query(spark, sf_dir):
    store = table(spark, sf_dir, "supplier").selectExpr(
        "'s' || s_suppkey || '.example' AS id",
        "'https://s' || s_suppkey || '.example' AS domain",
        "s_name AS commercial_name",
        "'' AS legal_name",
        "array(s_name) AS all_available_names",
        "cast(null AS array<string>) AS phone_numbers",
    )
    run = scrape_companies(store, site_seeds(spark, sf_dir), long_captures(spark, sf_dir))
    return run.result.store.select("id", "commercial_name", "phone_numbers")


@query(
    "next_link",
    """
    SELECT page_id, CASE WHEN page_id % 3 = 0 AND len(links) >= 3 THEN '/about-' || page_id || '-contact'
                         WHEN page_id % 3 = 1 THEN '/about-' || page_id
                         ELSE links[1] END AS link
    FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1),
                                             'href="([^"]*)"', 1) AS links FROM pages)
    """,
)
def next_link_query(spark, sf_dir):
    """Links of each page's nav with an about and a contact link mixed in."""
    links = hrefs_in_nav(link_tags("html"))
    about = F.concat(F.lit("/about-"), F.col("page_id").cast("string"))
    contact = F.concat(about, F.lit("-contact"))
    kind = F.col("page_id") % 3
    queue = (
        F.when((kind == 0) & (F.size(links) >= 3), F.concat(links, F.array(about, contact)))
        .when(kind == 1, F.concat(links, F.array(about)))
        .otherwise(links)
    )
    return table(spark, sf_dir, "pages").select("page_id", next_link(queue).alias("link"))


# --- sitemaps ----------------------------------------------------------------
_N = "CAST(floor(page_id / 16) AS bigint)"
# Every seventh site has no robots file, the next a bad line, the next none at all.
_ROBOTS = """CASE n % 7 WHEN 1 THEN 'User-agent: *' || chr(10) || 'Sitemap: nope nope'
                        WHEN 2 THEN 'User-agent: *' || chr(10) || 'Disallow: /x'
                        ELSE 'User-agent: *' || chr(13) || chr(10) || '  Sitemap:  https://s' || n
                             || '.example/index.xml ' || chr(10) || 'Sitemap: https://x.example/' END"""
_XML = "'<?xml version=\"1.0\" encoding=\"UTF-8\"?>' || chr(10) || "
_NS = "xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\""


def _xml(tag: str, item: str, locs: str) -> str:
    return (
        f"{_XML} '<{tag} {_NS}>' || concat_ws('', transform({locs}, u -> "
        f"'<{item}><loc>' || u || '</loc></{item}>')) || '</{tag}>'"
    )


def sites(spark, sf_dir):
    numbers = table(spark, sf_dir, "pages").selectExpr(f"{_N} AS n").distinct()
    return numbers.selectExpr("n", "'https://s' || n || '.example' AS url")


def sitemap_captures(spark, sf_dir):
    """Robots, an index of three sitemaps (one off-site, one a nested index) and the
    lists of each site's page ids."""
    site = sites(spark, sf_dir)
    robots = site.where("n % 7 <> 0").selectExpr(
        "url || '/robots.txt' AS url", "404 AS status", "cast(null AS string) AS error", f"{_ROBOTS} AS body"
    )
    index = site.selectExpr(
        "url || '/index.xml' AS url",
        "200 AS status",
        "cast(null AS string) AS error",
        _xml(
            "sitemapindex",
            "sitemap",
            "array(url || '/nested.xml', 'https://other.example/b.xml', url || '/b.xml', url || '/none.xml')",
        )
        + " AS body",
    )
    nested = site.selectExpr(
        "url || '/nested.xml' AS url",
        "200 AS status",
        "cast(null AS string) AS error",
        _xml("sitemapindex", "sitemap", "array(url || '/index.xml', url || '/a.xml')") + " AS body",
    )
    lists = table(spark, sf_dir, "pages").selectExpr(
        f"{_SITE} || CASE WHEN page_id % 16 < 8 THEN '/a.xml' ELSE '/b.xml' END AS url",
        f"{_N} * 16 + CASE WHEN page_id % 16 < 8 THEN 0 ELSE 8 END AS first_id",
    )
    urlsets = lists.distinct().selectExpr(
        "url",
        "200 AS status",
        "cast(null AS string) AS error",
        _xml(
            "urlset", "url", "transform(sequence(first_id, first_id + 7), i -> 'https://s.example/page/' || i)"
        )
        + " AS body",
    )
    return robots.unionByName(index).unionByName(nested).unionByName(urlsets)


_SITES_SQL = f"SELECT DISTINCT {_N} AS n, 'https://s' || {_N} || '.example' AS url FROM pages"
_HAS_B = f"SELECT DISTINCT {_N} AS n FROM pages WHERE page_id % 16 >= 8"
_ROBOTS_SQL = f"""
  SELECT url, CASE WHEN n % 7 > 2 THEN url || '/index.xml' END AS sitemap_url,
         CASE n % 7 WHEN 0 THEN 'not_captured' WHEN 1 THEN 'invalid_url' WHEN 2 THEN 'not_found' END AS error
  FROM ({_SITES_SQL})
"""
_LINKS_SQL = f"""
  SELECT 'https://s' || n || '.example' AS url, path, i % 8 AS pos, 'https://s.example/page/' || (n * 16 + i) AS link
  FROM (SELECT n, CASE WHEN i < 8 THEN '0,1' ELSE '2' END AS path, i
        FROM (SELECT n, unnest(range(0, 16)) AS i FROM ({_SITES_SQL})) s
        WHERE n % 7 > 2 AND (i < 8 OR n IN (SELECT n FROM ({_HAS_B}))))
"""


@query(
    "sitemap_from_robots",
    f"""
    SELECT url || '/robots.txt' AS url, sitemap_url, error FROM ({_ROBOTS_SQL}) WHERE error IS DISTINCT FROM 'not_captured'
    """,
)
def sitemap_from_robots_query(spark, sf_dir):
    robots = sites(spark, sf_dir).where("n % 7 <> 0").selectExpr(
        "url || '/robots.txt' AS url", f"{_ROBOTS} AS body"
    )
    return robots.select("url", sitemap_from_robots("body").alias("s")).select(
        "url", F.col("s.url").alias("sitemap_url"), "s.error"
    )


@query("robots_sitemaps", _ROBOTS_SQL)
def robots_sitemaps_query(spark, sf_dir):
    return robots_sitemaps(sites(spark, sf_dir), sitemap_captures(spark, sf_dir))


@query(
    "sitemap_locs",
    f"""
    SELECT 'https://s' || n || CASE WHEN i < 8 THEN '.example/a.xml' ELSE '.example/b.xml' END AS url,
           i % 8 AS pos, 'https://s.example/page/' || (n * 16 + i) AS loc
    FROM (SELECT n, unnest(range(0, 16)) AS i FROM ({_SITES_SQL}))
    WHERE i < 8 OR n IN (SELECT n FROM ({_HAS_B}))
    """,
)
def sitemap_locs_query(spark, sf_dir):
    return sitemap_locs(sitemap_captures(spark, sf_dir), ["url"])


def _flat(links):
    return links.withColumn("path", F.array_join(F.col("path").cast("array<string>"), ","))


@query("sitemap_index_expand", _LINKS_SQL)
def sitemap_index_expand_query(spark, sf_dir):
    roots = sites(spark, sf_dir).where("n % 7 > 2").selectExpr("url", "url || '/index.xml' AS sitemap_url")
    return _flat(expand_sitemaps(roots, sitemap_captures(spark, sf_dir)))


@query("sitemap_links", _LINKS_SQL)
def sitemap_links_query(spark, sf_dir):
    links, _ = sitemap_links(sites(spark, sf_dir), sitemap_captures(spark, sf_dir))
    return _flat(links)


# --- stream ------------------------------------------------------------------
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
_STREAM_ROWS = f"""
  SELECT {_HOST} AS id, number, min(url || '|' || lpad(pos::VARCHAR, 9, '0')) AS place
  FROM (SELECT url, pos, valid_number AS number FROM ({validated(page_phone_rows('pages', tel=False))})
        WHERE error IS NULL)
  GROUP BY 1, number
"""


def _host_store(pages):
    return pages.selectExpr(f"{_HOST} AS id").distinct().selectExpr(
        "id",
        "'https://' || id AS domain",
        "id AS commercial_name",
        "'' AS legal_name",
        "array(id) AS all_available_names",
        "cast(null AS array<string>) AS phone_numbers",
    )


@query(
    "stream_scrape_updates",
    f"""
    SELECT h.id, n.phone_numbers FROM (SELECT DISTINCT {_HOST} AS id FROM pages) h
    LEFT JOIN (SELECT id, list(number ORDER BY place) AS phone_numbers FROM ({_STREAM_ROWS}) GROUP BY id) n
      ON n.id = h.id
    """,
    lists=("phone_numbers",),
)
def stream_scrape_updates_query(spark, sf_dir):
    """The pages as a stream of files into the log, then into a store of all hosts."""
    pages = table(spark, sf_dir, "pages")
    work = scratch_dir(spark)
    stream = stream_captures(spark, f"{sf_dir}/pages*.parquet", pages.schema, body="html")
    start_scrape_stream(stream, f"{work}/log", f"{work}/checkpoint").awaitTermination()
    return apply_log(_host_store(pages), read_log(spark, f"{work}/log")).store.select("id", "phone_numbers")


ARRIVALS = 4


@query(
    "stream_into_store",
    f"""
    WITH arrived AS (
      SELECT arrival, id, list(number ORDER BY place) AS phone_numbers FROM (
        SELECT page_id % {ARRIVALS} AS arrival, {_HOST} AS id, number, min(url || '|' || lpad(pos::VARCHAR, 9, '0')) AS place
        FROM (SELECT p.page_id, p.url, v.pos, v.valid_number AS number
              FROM ({validated(page_phone_rows('pages', tel=False))}) v JOIN pages p ON p.page_id = v.page_id
              WHERE v.error IS NULL)
        GROUP BY ALL)
      GROUP BY ALL
    )
    SELECT after_batch, id, last.phone_numbers
    FROM (SELECT DISTINCT {_HOST} AS id FROM pages) CROSS JOIN (SELECT unnest(range({ARRIVALS})) AS after_batch)
    LEFT JOIN (SELECT s.after_batch, a.id, max_by(a.phone_numbers, a.arrival) AS phone_numbers
               FROM arrived a JOIN (SELECT unnest(range({ARRIVALS})) AS after_batch) s ON a.arrival <= s.after_batch
               GROUP BY ALL) last USING (after_batch, id)
    """,
    lists=("phone_numbers",),
)
def stream_into_store_query(spark, sf_dir):
    """The pages arrive in four parts; the store after each micro-batch.

    Each batch but the first is followed by the one before it once more, which must not count.
    """
    pages = table(spark, sf_dir, "pages")
    work = scratch_dir(spark)
    store = CompanyStore(spark, f"{work}/store", f"store_{uuid.uuid4().hex}")
    store.create(_host_store(pages))
    after = []
    for batch in range(ARRIVALS):
        arrived = pages.where(f"page_id % {ARRIVALS} = {batch}")
        arrived.write.parquet(f"{work}/in/{batch}")
        stream = stream_captures(spark, f"{work}/in/*", pages.schema, body="html")
        start_store_stream(stream, store, f"{work}/checkpoint").awaitTermination()
        if batch:
            merge_batch(store, load_captures(spark.read.parquet(f"{work}/in/{batch - 1}"), body="html"), batch - 1)
        after.append(store.read().select(F.lit(batch).alias("after_batch"), "id", "phone_numbers"))
    return reduce(lambda a, b: a.unionByName(b), after)
