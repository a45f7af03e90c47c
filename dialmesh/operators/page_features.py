"""What one page gives: phone candidates and navigation links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import body_text, hrefs_in_body, hrefs_in_nav, link_tags, trimmed_hrefs
from ..functions.phones import match_phones, tel_phones


def page_features(captures: DataFrame, body: str = "body") -> DataFrame:
    """Replace the body by ``phones`` (text matches, then tel links, each in document
    order) and ``nav`` (trimmed hrefs of the nav links).  Narrow: no shuffle."""
    return (
        captures.withColumn("_tags", link_tags(body))
        .withColumn(
            "phones",
            F.concat(match_phones(body_text(body)), tel_phones(hrefs_in_body("_tags"))),
        )
        .withColumn("nav", trimmed_hrefs(hrefs_in_nav("_tags")))
        .drop("_tags", body)
    )
