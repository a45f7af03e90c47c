"""Companies as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from ..functions.urls import parse_url_checked

JSON_SCHEMA = (
    "domain string, commercial_name string, legal_name string, "
    "all_available_names array<string>, id string, phone_numbers array<string>"
)
_NAMES = [part.split()[0] for part in JSON_SCHEMA.split(", ")]
_FIELDS = ["domain", "commercial_name", "legal_name", "all_available_names"]


def company_json(with_id: bool = True) -> Column:
    """JSON text of a company row; an empty phone list is left out, empty names stay."""
    fields = [F.col(name) for name in _FIELDS]
    if with_id:
        phones = F.when(F.size("phone_numbers") > 0, F.col("phone_numbers"))
        fields += [F.col("id"), phones.alias("phone_numbers")]
    text = F.to_json(F.struct(*fields))
    for char in "<>&\u2028\u2029":  # safe inside HTML and scripts
        text = F.replace(text, F.lit(char), F.lit(f"\\u{ord(char):04x}"))
    return text


def parse_company_json(document: Column | str) -> Column:
    """The struct of a company document; NULL fields where the document has none."""
    return F.from_json(document, JSON_SCHEMA)


def read_company_json(document: Column | str) -> Column:
    """``struct<company, error>``: ``parse_error`` for a text that is no such document, else
    the error of its domain, which must be a URL; ``company`` is NULL then."""

    def checked(parsed: Column) -> Column:
        company = F.struct(*[parsed[name].alias(name) for name in _NAMES])
        error = F.when(parsed.isNull() | parsed["_corrupt"].isNotNull(), F.lit("parse_error")).otherwise(
            parse_url_checked(F.coalesce(parsed["domain"], F.lit("")))["error"]
        )
        return bind(error, lambda e: F.struct(F.when(e.isNull(), company).alias("company"), e.alias("error")))

    options = {"columnNameOfCorruptRecord": "_corrupt"}
    return bind(F.from_json(document, f"{JSON_SCHEMA}, _corrupt string", options), checked)


def write_company_json(companies: DataFrame, path: str) -> None:
    companies.select(company_json().alias("value")).write.text(path)
