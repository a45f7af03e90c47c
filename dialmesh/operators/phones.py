"""Phone rows: extraction, validation, rejects, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import add_once, explode_positions
from ..functions.phones import confidence_label, match_phones, validate_phone
from .page_features import page_features


def _phone_rows(df: DataFrame, keys: list[str], phones: str) -> DataFrame:
    rows = explode_positions(df, keys, F.col(phones), "_phone")
    return rows.select(*keys, "pos", "_phone.number", "_phone.confidence")


def text_phones(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, pos, number, confidence`` of all matches in plain texts."""
    return _phone_rows(texts.select(*keys, match_phones(text).alias("_phones")), keys, "_phones")


def page_phones(pages: DataFrame, keys: list[str], body: str = "body", raw: bool = True):
    """Numbers of pages: text matches first, then tel links, in document order.

    ``raw=False`` validates and dedupes per page.
    """
    features = page_features(pages.select(*keys, body), body)
    rows = _phone_rows(features, keys, "phones")
    return rows if raw else sanitize_phones(rows, keys, ["pos"])


def validate_phones(phones: DataFrame, area_codes: list[str] | None = None) -> DataFrame:
    """Add ``valid_number`` and ``error``; the confidence stays as it was."""
    return (
        add_once(phones, "_check", validate_phone("number", area_codes))
        .withColumn("valid_number", F.col("_check.number"))
        .withColumn("error", F.col("_check.error"))
        .drop("_check")
    )


def phone_rejects(phones: DataFrame, keys: list[str], area_codes: list[str] | None = None):
    """``keys, idx, number, reason`` of the numbers that fail validation."""
    checked = validate_phones(phones, area_codes)
    return checked.where("error is not null").select(
        *keys, F.col("pos").alias("idx"), "number", F.col("error").alias("reason")
    )


def valid_phones(phones: DataFrame, area_codes: list[str] | None = None) -> DataFrame:
    """The rows that pass, with the number in international format."""
    checked = validate_phones(phones, area_codes)
    return checked.where("error is null").withColumn("number", F.col("valid_number")).drop(
        "valid_number", "error"
    )


def dedup_phones(phones: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """One row per scope and number with the highest confidence and the first place.

    Two aggregates with map-side combine on (scope, number): a hot scope spreads
    over its numbers and a hot number shrinks before the shuffle.
    """
    grouped = phones.groupBy(*scope, "number").agg(
        F.max("confidence").alias("confidence"), F.min(F.struct(*order)).alias("_first")
    )
    return grouped.select(*scope, "number", "confidence", "_first.*")


def sanitize_phones(
    phones: DataFrame, scope: list[str], order: list[str], area_codes: list[str] | None = None
) -> DataFrame:
    """Validation (rejects dropped), then deduplication."""
    return dedup_phones(valid_phones(phones, area_codes), scope, order)


def label_phones(phones: DataFrame) -> DataFrame:
    return phones.withColumn("label", confidence_label("confidence"))
