"""Links of a site from its robots file and sitemaps, over a table of captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..frames import add_once, explode_positions
from ..functions.text import WHITE_SPACE, trim_space
from ..functions.urls import (
    INVALID_URL,
    allowed_host,
    capture_key,
    normal_url,
    robots_url,
    syntax_error,
    url_host,
    visit_url,
)
from ..joins import lookup_join
from ..session import BucketedTable, materialize, scratch_dir
from ..sources.captures import visit_failed

NOT_FOUND = "not_found"
NOT_CAPTURED = "not_captured"

_BLANK = WHITE_SPACE.replace(r"\t-\r", r"\t\x0b-\r")  # white space other than the line feed
_SITEMAP_LINE = rf"(?md)^[{_BLANK}]*+Sitemap:([^\n]*+)"
_ROOT = (
    r"(?s)^\x{FEFF}?(?:\s++|<\?.*?\?>|<!--.*?-->|<![A-Za-z][^>\[]*+(?:\[[^\]]*+\]\s*+)?+>)*+"
    r"<([A-Za-z_][\w.\-]*+)(?=[\s/>])"
)
_LOCS = "array<struct<loc:array<string>>>"
_XML = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}


def sitemap_from_robots(body: Column | str) -> Column:
    """``struct<url, error>`` of the first ``Sitemap:`` line; later lines never count."""
    text = F.col(body) if isinstance(body, str) else body
    raw = trim_space(F.regexp_extract(text, _SITEMAP_LINE, 1))
    found = text.rlike(_SITEMAP_LINE)
    bad = syntax_error(raw) | (url_host(raw) == "")
    return F.struct(
        F.when(found & ~bad, normal_url(raw)).alias("url"),
        F.when(~F.coalesce(found, F.lit(False)), F.lit(NOT_FOUND))
        .when(bad, F.lit(INVALID_URL))
        .alias("error"),
    )


def sitemap_entries(body: Column | str) -> Column:
    """``struct<locs, sitemaps>``: texts of ``urlset/url/loc`` and of
    ``sitemapindex/sitemap/loc``, in document order; empty for other or broken XML."""
    text = F.col(body) if isinstance(body, str) else body
    root = F.regexp_extract(text, _ROOT, 1)
    tree = F.from_xml(text, f"url {_LOCS}, sitemap {_LOCS}", _XML)

    def locs(tag: str, name: str) -> Column:
        entries = F.transform(F.filter(tree[name], lambda e: e["loc"].isNotNull()), lambda e: e["loc"])
        flat = F.filter(F.flatten(entries), lambda t: t.isNotNull())
        return F.coalesce(F.when(root == tag, flat), F.array().cast("array<string>"))

    return F.struct(
        locs("urlset", "url").alias("locs"), locs("sitemapindex", "sitemap").alias("sitemaps")
    )


def _parsed_sitemaps(captures: DataFrame) -> DataFrame:
    """``key, locs, sitemaps``: one row per address that has a good capture.

    Bodies are read where they lie; of several captures of an address the first by URL and
    entries wins, and only entries move.
    """
    good = captures.where(visit_failed().isNull())
    read = add_once(good.select(capture_key("url").alias("key"), "url", "body"), "_e", sitemap_entries("body"))
    first = F.min(F.struct("url", "_e.locs", "_e.sitemaps")).alias("_c")
    return read.groupBy("key").agg(first).select("key", "_c.locs", "_c.sitemaps")


def robots_sitemaps(sites: DataFrame, captures: DataFrame) -> DataFrame:
    """``url, sitemap_url, error`` per site URL.  The status of the robots answer does
    not matter, only a failed request does."""
    robots = captures.where(capture_key("url").rlike(r"/robots\.txt(?:\?|$)"))
    # Read before the shuffle, which then carries one address instead of a body.
    entries = add_once(robots, "_s", sitemap_from_robots("body")).select(
        capture_key("url").alias("key"),
        F.struct(
            F.col("error").isNotNull().alias("failed"),
            "url",
            F.col("_s.url").alias("sitemap_url"),
            F.coalesce("error", "_s.error").alias("error"),
        ).alias("_c"),
    )
    # Of several captures of one address a good one wins.
    one = entries.groupBy("key").agg(F.min("_c").alias("_c"))
    keyed = sites.select("url", robots_url("url").alias("key"))
    joined = lookup_join(keyed, one, "key", "left")
    error = F.when(F.col("_c").isNull(), F.lit(NOT_CAPTURED)).otherwise(F.col("_c.error"))
    return joined.select(
        "url", F.when(error.isNull(), F.col("_c.sitemap_url")).alias("sitemap_url"), error.alias("error")
    )


def sitemap_locs(captures: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, pos, loc`` of every urlset."""
    return explode_positions(captures, keys, sitemap_entries("body")["locs"], "loc")


def expand_sitemaps(roots: DataFrame, captures: DataFrame) -> DataFrame:
    """Follow sitemap indexes from ``roots(url, sitemap_url)``.

    Gives ``url, path, pos, link``: ``path`` is the list of positions that led to the
    sitemap, so ordering by (path, pos) is the depth-first order of visits.  Entries
    on another host, not captured, failed or already on the way are skipped.  Each
    level is one join with the parsed sitemaps, spread by address; the loop ends when
    a level finds no further index.
    """
    spark = roots.sparkSession
    xml = captures.where(F.col("body").contains("<urlset") | F.col("body").contains("<sitemapindex"))
    nodes = BucketedTable(_parsed_sitemaps(xml), "key")
    try:
        return _levels(spark, roots, nodes.df)
    finally:
        nodes.drop()


def _levels(spark, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    frontier = roots.where("sitemap_url is not null").select(
        "url",
        url_host("sitemap_url").alias("host"),
        visit_url("sitemap_url").alias("at"),
        F.array().cast("array<int>").alias("path"),
        F.array().cast("array<string>").alias("above"),
    )
    folder = scratch_dir(spark)
    level, rows = 0, roots.count()
    while True:
        keyed = frontier.withColumn("key", capture_key("at"))
        joined = lookup_join(keyed, nodes, "key", rows=rows).drop("key")
        counts = Observation()
        listed = F.sum(F.size("sitemaps")).alias("listed")
        seen = materialize(joined.observe(counts, listed), f"{folder}/level={level}")
        schema = seen.schema
        rows = counts.get["listed"]  # no fewer than the next level has
        if not rows:
            break
        frontier = (
            seen.where(F.size("sitemaps") > 0)
            .withColumn("above", F.array_append("above", F.col("at")))
            .select("url", "host", "path", "above", F.posexplode("sitemaps").alias("pos", "loc"))
            .transform(add_once, "at", visit_url("loc"))
            .where(allowed_host(url_host("at"), "host") & ~F.array_contains("above", F.col("at")))
            .groupBy("url", "at")
            .agg(F.min(F.struct(F.array_append("path", F.col("pos")).alias("path"), "host", "above")).alias("_m"))
            .select("url", "_m.host", "at", "_m.path", "_m.above")
        )
        level += 1
    everything = spark.read.schema(schema).parquet(folder)
    # A sitemap is visited once per site, at the first of its places.
    once = everything.where(F.size("locs") > 0).groupBy("url", "at").agg(
        F.min_by(F.struct("path", "locs"), "path").alias("_m")
    )
    return once.select(
        "url", F.col("_m.path").alias("path"), F.posexplode("_m.locs").alias("pos", "link")
    )


def sitemap_links(sites: DataFrame, captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Site → robots → sitemaps.  Gives the links and the sites' ``url, sitemap_url,
    error`` (an unreadable first sitemap is ``not_captured``)."""
    roots = materialize(robots_sitemaps(sites, captures))  # used by both results
    links = expand_sitemaps(roots, captures)
    answered = captures.where(visit_failed().isNull()).select(
        capture_key("url").alias("_key")
    ).distinct()
    # Sites without a sitemap get a key of their own instead of sharing NULL.
    keyed = roots.withColumn(
        "_key", F.coalesce(capture_key("sitemap_url"), F.concat(F.lit("#"), F.col("url")))
    )
    status = (
        lookup_join(keyed, answered.withColumn("_hit", F.lit(True)), "_key", "left")
        .select(
            "url",
            "sitemap_url",
            F.coalesce(
                "error", F.when(F.col("_hit").isNull(), F.lit(NOT_CAPTURED))
            ).alias("error"),
        )
    )
    return links, status
