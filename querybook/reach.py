"""Reachability report; the events stand in for a log of probes."""

from __future__ import annotations

from dialmesh.operators.reachability import (
    bad_status_histogram,
    check_results,
    classify_status,
    reachability_summary,
    successful_urls,
)

from .base import query, table

_STATUS = """CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 200 WHEN 'click' THEN 200
             WHEN 'purchase' THEN 404 ELSE 503 END"""
_PROBE = f"""'https://h' || event_id || '.example' AS url, {_STATUS} AS status,
             CASE WHEN event_type = 'error' THEN 'no such host' END AS error"""
# Input addresses repeat, and some were never probed.
_ADDRESS = "'https://h' || (event_id * 3 % 25000) || '.example' AS url"

_RESULTS = f"""
  SELECT u.idx, u.url, CASE WHEN p.error IS NULL THEN coalesce(p.status, 0) ELSE 0 END AS status,
         CASE WHEN p.url IS NULL THEN 'no_probe' ELSE p.error END AS error
  FROM (SELECT event_id AS idx, {_ADDRESS} FROM events) u
  LEFT JOIN (SELECT {_PROBE} FROM events) p ON u.url = p.url
"""
_CLASS = """CASE WHEN status = 200 THEN 'successful' WHEN error IS NOT NULL THEN 'failed'
            ELSE 'bad' END"""


def results(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    urls = events.selectExpr("event_id AS idx", _ADDRESS)
    log = events.selectExpr(
        "'https://h' || event_id || '.example' AS url",
        f"{_STATUS} AS status",
        "CASE WHEN event_type = 'error' THEN 'no such host' END AS error",
    )
    return check_results(urls, log)


@query("check_results", _RESULTS)
def check_results_query(spark, sf_dir):
    return results(spark, sf_dir).orderBy("idx")


@query("classify_status", f"SELECT idx, {_CLASS} AS class FROM ({_RESULTS})")
def classify_status_query(spark, sf_dir):
    return results(spark, sf_dir).select("idx", classify_status().alias("class"))


@query(
    "reachability_summary",
    f"""
    SELECT count(*) FILTER (c = 'successful') AS successful, count(*) FILTER (c = 'failed') AS failed,
           count(*) FILTER (c = 'bad') AS bad
    FROM (SELECT {_CLASS} AS c FROM ({_RESULTS}))
    """,
)
def reachability_summary_query(spark, sf_dir):
    return reachability_summary(results(spark, sf_dir))


@query(
    "bad_status_histogram",
    f"SELECT status, count(*) AS n FROM ({_RESULTS}) WHERE {_CLASS} = 'bad' GROUP BY status",
)
def bad_status_histogram_query(spark, sf_dir):
    return bad_status_histogram(results(spark, sf_dir))


@query("successful_urls", f"SELECT idx, url FROM ({_RESULTS}) WHERE status = 200")
def successful_urls_query(spark, sf_dir):
    return successful_urls(results(spark, sf_dir))
