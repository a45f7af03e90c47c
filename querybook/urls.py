"""URL operators over the pages' addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialmesh.functions.urls import (
    allowed_host,
    company_id,
    host_name,
    parse_url_checked,
    robots_url,
    url_host,
)

from .base import query, table

# Every page address in one of eight spellings, good and bad.
_SPELLINGS = """
  CASE page_id % 8
    WHEN 1 THEN substr(url, instr(url, '//') + 2)
    WHEN 2 THEN '  ' || url || '  '
    WHEN 3 THEN replace(url, '.', ' ')
    WHEN 4 THEN replace(replace(url, 'https', 'redis'), 'http', 'redis')
    WHEN 5 THEN ''
    WHEN 6 THEN replace(replace(replace(url, '.example', '_x.example'), 'http', 'HTTP'), '/en/', ':8080/en/')
    WHEN 7 THEN '/x?u=' || url
    ELSE url
  END
"""

_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"


@query(
    "parse_url_checked",
    f"""
    WITH raw AS (SELECT page_id, trim({_SPELLINGS}) AS t FROM pages),
    full_url AS (
      SELECT page_id, t, CASE WHEN contains(t, '://') THEN t ELSE 'https://' || t END AS u FROM raw
    ),
    parts AS (
      SELECT page_id, t, u,
             regexp_extract(u, '^([A-Za-z]+)://', 1) AS s,
             regexp_extract(u, '^[A-Za-z]+://([^/?#]*)', 1) AS h
      FROM full_url
    ),
    checked AS (
      SELECT *, CASE WHEN t = '' THEN 'missing_host'
                     WHEN contains(h, ' ') THEN 'invalid_url'
                     WHEN h = '' THEN 'missing_host'
                     WHEN lower(s) NOT IN ('http', 'https') THEN 'invalid_scheme' END AS error
      FROM parts
    )
    SELECT page_id, error,
           CASE WHEN error IS NULL THEN lower(s) || substr(u, length(s) + 1) END AS url,
           CASE WHEN error IS NULL THEN lower(s) END AS scheme,
           CASE WHEN error IS NULL THEN h END AS host,
           CASE WHEN error IS NULL THEN regexp_replace(h, ':[0-9]*$', '') END AS hostname
    FROM checked
    """,
)
def parse_url_checked_query(spark, sf_dir):
    spelled = table(spark, sf_dir, "pages").selectExpr("page_id", f"{_SPELLINGS} AS raw")
    return spelled.select("page_id", parse_url_checked("raw").alias("p")).select(
        "page_id", "p.error", "p.url", "p.scheme", "p.host", "p.hostname"
    )


@query("company_id", f"SELECT page_id, {_HOST} AS id FROM pages")
def company_id_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", company_id("url").alias("id"))


@query(
    "allowed_host",
    f"""
    WITH h AS (SELECT page_id, {_HOST} AS host FROM pages),
    s AS (SELECT *, regexp_replace(host, '^(www|m|blog)\\.', '') AS seed_host FROM h)
    SELECT page_id, host, seed_host, host = seed_host OR host = 'www.' || seed_host AS allowed FROM s
    """,
)
def allowed_host_query(spark, sf_dir):
    hosts = table(spark, sf_dir, "pages").select("page_id", host_name(url_host("url")).alias("host"))
    seeded = hosts.withColumn("seed_host", F.regexp_replace("host", r"^(www|m|blog)\.", ""))
    return seeded.withColumn("allowed", allowed_host("host", "seed_host"))


@query(
    "robots_url",
    """
    SELECT page_id,
           regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/robots.txt'
             || regexp_extract(url, '(\\?[^#]*)', 1) AS robots
    FROM pages
    """,
)
def robots_url_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", robots_url("url").alias("robots"))
