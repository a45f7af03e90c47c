"""Links of pages, one row per link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import explode_positions
from ..functions.html import hrefs_in_body, hrefs_in_nav, link_tags, trimmed_hrefs
from ..functions.phones import tel_phones

SELECTORS = {"nav": hrefs_in_nav, "body": hrefs_in_body}


def page_links(pages: DataFrame, keys: list[str], selector: str = "nav", body: str = "body"):
    """``keys, pos, href``: the trimmed raw hrefs below ``nav`` or ``body``,
    in document order, duplicates kept."""
    hrefs = SELECTORS[selector](F.col("_tags"))
    tagged = pages.select(*keys, link_tags(body).alias("_tags"))
    return explode_positions(tagged, keys, trimmed_hrefs(hrefs), "href")


def nav_links(pages: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    return page_links(pages, keys, "nav", body)


def body_links(pages: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    return page_links(pages, keys, "body", body)


def distinct_links(links: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """First occurrence of each raw href per scope: ``scope, href, order...``.

    Grouped by (scope, href) with partial aggregation, so a scope of any size
    spreads over its hrefs.
    """
    first = links.groupBy(*scope, "href").agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(*scope, "href", "_first.*")


def tel_links(pages: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """``keys, pos, number``: numbers of the ``tel:`` links in document order."""
    phones = tel_phones(hrefs_in_body(link_tags(body)))
    rows = explode_positions(pages, keys, phones, "_phone")
    return rows.select(*keys, "pos", F.col("_phone.number").alias("number"))
