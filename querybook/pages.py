"""Text, links and phone numbers of the pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialmesh.functions.html import body_text
from dialmesh.functions.urls import company_id
from dialmesh.operators.links import body_links, distinct_links, nav_links, tel_links
from dialmesh.operators.page_features import page_features
from dialmesh.operators.phones import page_phones
from dialmesh.plans.contact_pages import site_phones
from dialmesh.sources.captures import load_captures, visit_failed

from .base import query, table
from .phones import BLANKS, PATTERN, validated

HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"

# The pages have neither tel links nor links outside nav: both are appended.
EXTRA = (
    "'<p><a href=\" /page/' || page_id || ' \">more</a>'"
    " || '<a class=b href=\"tel:+1541754' || lpad(cast(page_id % 10000 AS string), 4, '0') || '\">call</a>'"
    " || '<a href=\"tel:' || cast(page_id AS string) || '\">bad</a>'"
)


def sql_text(html: str) -> str:
    """Body text on this page shape: no script or style below body, five entities."""
    text = f"regexp_replace({html}, '(?s)^.*<body>', '')"
    text = f"regexp_replace({text}, '(?s)<!--.*?-->|<[^>]*>', '', 'g')"
    for ref, char in (("quot", '"'), ("copy", "©"), ("middot", "·")):
        text = f"replace({text}, '&{ref};', '{char}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


_SQL_EXTRA = EXTRA.replace("AS string", "AS VARCHAR")
EXTENDED = f"(SELECT page_id, url, html || {_SQL_EXTRA} AS html FROM pages)"


def extended_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr("page_id", "url", f"html || {EXTRA} AS html")


def page_phone_rows(pages: str, tel: bool) -> str:
    """SQL rows (page_id, url, pos, number, confidence) of ``pages(page_id, url, html)``."""
    tels = (
        "regexp_extract_all(html, 'href=\"tel:([^\"]*)\"', 1)" if tel else "CAST([] AS VARCHAR[])"
    )
    return f"""
    SELECT page_id, url, (i - 1)::INT AS pos, trim(both_lists[i], {BLANKS}) AS number,
           CASE WHEN i > n THEN 2 ELSE 0 END AS confidence
    FROM (
      SELECT page_id, url, len(m) AS n, list_concat(m, t) AS both_lists,
             unnest(range(1, len(m) + len(t) + 1)) AS i
      FROM (
        SELECT page_id, url, regexp_extract_all({sql_text('html')}, '{PATTERN}') AS m, {tels} AS t
        FROM {pages}
      )
    )
    """


@query(
    "load_captures",
    """
    SELECT url, CASE WHEN page_id % 9 = 4 THEN 404 ELSE 200 END AS status,
           CASE WHEN page_id % 11 = 7 THEN 'timeout' END AS error, html AS body,
           CASE WHEN page_id % 11 = 7 THEN 'timeout'
                WHEN page_id % 9 = 4 THEN 'status_404' END AS failure
    FROM pages
    """,
)
def load_captures_query(spark, sf_dir):
    probed = table(spark, sf_dir, "pages").selectExpr(
        "url",
        "html",
        "CASE WHEN page_id % 9 = 4 THEN 404 ELSE 200 END AS status",
        "CASE WHEN page_id % 11 = 7 THEN 'timeout' END AS error",
    )
    captures = load_captures(probed, body="html", status="status", error="error")
    return captures.withColumn("failure", visit_failed())


@query("body_text", f"SELECT page_id, {sql_text('html')} AS text FROM {EXTENDED}")
def body_text_query(spark, sf_dir):
    return extended_pages(spark, sf_dir).select("page_id", body_text("html").alias("text"))


@query(
    "tel_links",
    f"""
    SELECT page_id, (i - 1)::INT AS pos, t[i] AS number
    FROM (SELECT page_id, t, unnest(range(1, len(t) + 1)) AS i
          FROM (SELECT page_id, regexp_extract_all(html, 'href="tel:([^"]*)"', 1) AS t FROM {EXTENDED}))
    """,
)
def tel_links_query(spark, sf_dir):
    return tel_links(extended_pages(spark, sf_dir), ["page_id"], "html")


def _links_sql(html: str) -> str:
    return f"""
    SELECT page_id, url, (i - 1)::INT AS pos, trim(h[i]) AS href
    FROM (SELECT page_id, url, h, unnest(range(1, len(h) + 1)) AS i
          FROM (SELECT page_id, url, regexp_extract_all({html}, '<a [^>]*?href="([^"]*)"', 1) AS h
                FROM {EXTENDED}))
    """


_NAV_SQL = _links_sql("regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)")
_BODY_SQL = _links_sql("html")


@query("nav_links", f"SELECT page_id, pos, href FROM ({_NAV_SQL})")
def nav_links_query(spark, sf_dir):
    return nav_links(extended_pages(spark, sf_dir), ["page_id"], "html")


@query("body_links", f"SELECT page_id, pos, href FROM ({_BODY_SQL})")
def body_links_query(spark, sf_dir):
    return body_links(extended_pages(spark, sf_dir), ["page_id"], "html")


@query(
    "distinct_links",
    f"""
    SELECT host, href, min(page_id) AS page_id, arg_min(pos, page_id * 1000000 + pos) AS pos
    FROM (SELECT {HOST} AS host, href, page_id, pos FROM ({_NAV_SQL})) GROUP BY host, href
    """,
)
def distinct_links_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("host", company_id("url"))
    links = nav_links(pages, ["host", "page_id"], "html")
    return distinct_links(links, ["host"], ["page_id", "pos"])


_RAW_ROWS = page_phone_rows(EXTENDED, tel=True)


@query("page_phones", f"SELECT page_id, pos, number, confidence FROM ({_RAW_ROWS})")
@query("raw_phones", f"SELECT page_id, pos, number, confidence FROM ({_RAW_ROWS})")
def page_phones_query(spark, sf_dir):
    return page_phones(extended_pages(spark, sf_dir), ["page_id"], "html", raw=True)


@query(
    "page_phones_clean",
    f"""
    SELECT page_id, number, max(confidence) AS confidence, min(pos) AS pos
    FROM (SELECT page_id, pos, valid_number AS number, confidence
          FROM ({validated(_RAW_ROWS)}) WHERE error IS NULL)
    GROUP BY page_id, number
    """,
)
def page_phones_clean_query(spark, sf_dir):
    return page_phones(extended_pages(spark, sf_dir), ["page_id"], "html", raw=False)


@query(
    "enough_info",
    f"""
    SELECT page_id, len(regexp_extract_all({sql_text('html')}, '{PATTERN}')) > 0 AS enough FROM pages
    """,
)
def enough_info_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("body"))
    return page_features(pages).select("page_id", (F.size("phones") > 0).alias("enough"))


@query(
    "site_phones",
    f"""
    SELECT site, number, max(confidence) AS confidence, 'regex match' AS label,
           arg_min(url, url || lpad(pos::VARCHAR, 9, '0')) AS url,
           arg_min(pos, url || lpad(pos::VARCHAR, 9, '0')) AS pos
    FROM (SELECT {HOST} AS site, url, pos, valid_number AS number, confidence
          FROM ({validated(page_phone_rows('pages', tel=False))}) WHERE error IS NULL)
    GROUP BY site, number
    """,
)
def site_phones_query(spark, sf_dir):
    return site_phones(load_captures(table(spark, sf_dir, "pages"), body="html"))
