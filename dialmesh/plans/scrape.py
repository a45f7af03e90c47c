"""Domains in, phone numbers of their sites into the company store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.companies import UpdateResult, update_companies
from ..operators.crawl import Crawl, crawl_sites, phones_to_company


@dataclass(frozen=True)
class ScrapeRun:
    crawl: Crawl
    updates: DataFrame  # url, phone_numbers
    result: UpdateResult


def scrape_companies(store: DataFrame, domains: DataFrame, captures: DataFrame) -> ScrapeRun:
    """Crawl ``domains(url)`` over the captures and merge what was found."""
    crawl = crawl_sites(domains, captures)
    updates = phones_to_company(crawl.phones())
    return ScrapeRun(crawl, updates, update_companies(store, updates))
