"""Bounded, prioritised crawl of many sites over a table of captures.

All sites advance together: step *k* joins one URL per live site with the pages'
features.  A site is one row whatever its number of pages, and pages are spread by
URL, so a site that owns a third of all pages makes no hot partition.  A row holds
the links of at most ``MAX_VISITS`` pages, which bounds it by page size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..frames import add_once, explode_positions
from ..functions.urls import allowed_host, capture_key, parse_url_checked, url_host, visit_url
from ..joins import BloomFilter, lookup_join
from ..session import BucketedTable, materialize, scratch_dir
from ..sources.captures import visit_failed
from .page_features import page_features
from .phones import sanitize_phones

MAX_VISITS = 11
PREFERRED = ("contact", "about")  # searched for in this order, case-sensitive

_LINKS = "array<string>"
_PHONES = "array<struct<number:string,confidence:int>>"


def next_link(queue: Column | str) -> Column:
    """The queued link to visit next: the first that contains ``contact``, else
    ``about``, else the first; NULL for an empty queue."""
    links = F.col(queue) if isinstance(queue, str) else queue

    def first_with(word: str) -> Column:
        return F.get(F.filter(links, lambda link: link.contains(word)), F.lit(0))

    return F.coalesce(*[first_with(word) for word in PREFERRED], F.get(links, F.lit(0)))


def enough_info(phones: Column | str) -> Column:
    """A site is done as soon as any number, valid or not, was found."""
    return F.size(phones) > 0


def within_page_limit(visited: Column | str) -> Column:
    return F.size(visited) < MAX_VISITS


@dataclass(frozen=True)
class Crawl:
    """``sites(seed, error, links_visited, phones)``: one row per seed, phones as
    found; the methods give row-shaped views."""

    sites: DataFrame

    def links_visited(self) -> DataFrame:
        """``seed, step, url`` in visit order."""
        return self.sites.select("seed", F.posexplode("links_visited").alias("step", "url"))

    def raw_phones(self) -> DataFrame:
        rows = explode_positions(self.sites, ["seed"], F.col("phones"), "_phone")
        return rows.select("seed", "pos", "_phone.number", "_phone.confidence")

    def phones(self) -> DataFrame:
        """``seed, number, confidence, pos``: valid numbers, deduped, first place."""
        return sanitize_phones(self.raw_phones(), ["seed"], ["pos"])

    def stats(self) -> DataFrame:
        """One row: seeds, failed seeds, seeds with at least one valid number."""
        found = self.phones().select("seed").distinct().withColumn("_found", F.lit(True))
        return (
            self.sites.select("seed", "error")
            .join(found, "seed", "left")
            .agg(
                F.count(F.lit(1)).alias("seeds"),
                F.count_if(F.col("error").isNotNull()).alias("failed_seeds"),
                F.count_if("_found").alias("seeds_with_phones"),
            )
        )


def phones_to_company(phones: DataFrame, url: str = "seed") -> DataFrame:
    """Update rows ``url, phone_numbers`` in order of first occurrence.

    A crawl stops at the first page with numbers, so a list comes from one page.
    """
    return phones.groupBy(F.col(url).alias("url")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "number"))), lambda p: p["number"]
        ).alias("phone_numbers")
    )


def _visitable(seeds: DataFrame, captures: DataFrame) -> DataFrame:
    """Captures on a host some seed may visit, and few others, found before any is parsed.

    The filter has a bounded size for any number of seeds; the crawl itself visits only what
    it may.
    """
    host = F.col("parsed.host")
    hosts = (
        seeds.where(host.isNotNull())
        .select(F.explode(F.array(host, F.concat(F.lit("www."), host))).alias("host"))
        .distinct()
    )
    return BloomFilter.build(hosts, "host").keep(captures, url_host("url"))


def crawl_features(captures: DataFrame) -> DataFrame:
    """One compact row per captured URL: ``key, failure, phones, nav``."""
    features = page_features(
        captures.select(capture_key("url").alias("key"), "url", visit_failed().alias("failure"), "body")
    )
    row = F.struct("failure", "phones", "nav")
    # Of several captures of one URL a good one wins, then the smallest text.
    rank = F.struct(F.col("failure").isNotNull(), "url", "failure", "phones")
    return features.groupBy("key").agg(F.min_by(row, rank).alias("page")).select("key", "page.*")


def crawl_sites(seeds: DataFrame, captures: DataFrame) -> Crawl:
    """Crawl every seed ``(url)`` over ``captures(url, status, error, body)``.

    Per site: visit the seed, queue its nav links (first occurrence of each raw
    href), go on with ``next_link`` until a number was found or ``MAX_VISITS`` pages
    were seen.  A follow-up that cannot be visited (off-site, relative, not
    captured, failed, seen before) ends the site with what was found.
    """
    spark = seeds.sparkSession
    jobs = seeds.select(F.col("url").alias("seed"))
    # Parsed once, as the pages' hosts, the count and the first step all ask for it.
    parsed = materialize(add_once(jobs.distinct(), "parsed", parse_url_checked("seed")))
    pages = BucketedTable(crawl_features(_visitable(parsed, captures)), "key")
    try:
        return Crawl(lookup_join(jobs, _advance(spark, parsed, pages.df), "seed"))
    finally:
        pages.drop()


def _advance(spark, parsed: DataFrame, pages: DataFrame) -> DataFrame:
    none = F.array()
    frontier = parsed.select(
        "seed",
        F.col("parsed.host").alias("host"),
        F.col("parsed.error").alias("bad_url"),
        F.col("parsed.url").alias("link"),
        none.cast(_LINKS).alias("queue"),
        none.cast(_LINKS).alias("seen"),
        none.cast(_LINKS).alias("visited"),
    )
    folder = scratch_dir(spark)
    visit = _visit_columns()
    live = parsed.select("seed").count()
    for step in range(MAX_VISITS):
        # The count of sites that go on comes with the write, without a job of its own.
        seen = Observation()
        after = _visit(frontier, live, pages, visit)
        counted = after.observe(seen, F.count("link").alias("live"))
        done = materialize(counted, f"{folder}/step={step}")
        schema = done.schema
        live = seen.get["live"]
        if not live:
            break
        frontier = done.where("link is not null").drop("error", "phones")
    finished = spark.read.schema(schema).parquet(folder).where("link is null")
    return finished.select("seed", "error", F.col("visited").alias("links_visited"), "phones")


def _visit_columns() -> list[dict[str, Column]]:
    """The columns of a step, in stages; built once as they are the same each time."""
    url = F.col("url")
    may_visit = allowed_host(url_host("url"), "host") & ~F.array_contains("visited", url)
    # A stand-in key of its own keeps a row without a visit off one NULL partition.
    key = F.coalesce(F.when(may_visit, capture_key("url")), F.concat(F.lit("#"), F.col("seed")))
    ok = F.col("nav").isNotNull() & F.col("failure").isNull()
    first = F.size("visited") == 0
    fresh = F.array_except("nav", "seen")  # distinct, in document order
    none = F.array().cast(_PHONES)
    error = F.when(first & ~ok, F.coalesce("bad_url", "failure", F.lit("not_captured")))
    go_on = F.col("ok") & ~enough_info("phones") & within_page_limit("visited")
    return [
        {"url": visit_url("link")},
        {"key": key},
        {
            "ok": ok,
            "error": error,
            "queue": F.when(ok, F.concat("queue", fresh)).otherwise(F.col("queue")),
            "seen": F.when(ok, F.concat("seen", fresh)).otherwise(F.col("seen")),
            "visited": F.when(ok, F.array_append("visited", url)).otherwise(F.col("visited")),
            "phones": F.when(ok, F.col("phones")).otherwise(none),
        },
        {"link": F.when(go_on, next_link("queue"))},
        {"queue": F.coalesce(F.array_remove("queue", F.col("link")), F.col("queue"))},
    ]


def _visit(
    frontier: DataFrame, rows: int, pages: DataFrame, columns: list[dict[str, Column]]
) -> DataFrame:
    """One step: visit each row's link and choose the next one (NULL = finished).

    Many seeds of one site may want the same page, hence the lookup join.
    """
    address, key, *after = columns
    probes = frontier.transform(add_once, "url", address["url"]).withColumns(key)
    hit = lookup_join(probes, pages, "key", "left", rows)
    for stage in after:
        hit = hit.withColumns(stage)
    return hit.drop("key", "url", "failure", "nav", "ok")
