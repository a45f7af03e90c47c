"""Which valid phone numbers does each site show, and how sure are we?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import company_id
from ..operators.phones import label_phones, page_phones, sanitize_phones


def site_phones(captures: DataFrame) -> DataFrame:
    """``site, number, confidence, label, url, pos`` over all captures of each site;
    (url, pos) is the first place of the number."""
    rows = page_phones(captures, ["url"], "body").withColumn("site", company_id("url"))
    return label_phones(sanitize_phones(rows, ["site"], ["url", "pos"])).select(
        "site", "number", "confidence", "label", "url", "pos"
    )


def phones_per_site(captures: DataFrame) -> DataFrame:
    return site_phones(captures).groupBy("site").agg(F.count(F.lit(1)).alias("numbers"))
