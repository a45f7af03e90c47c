"""Phone operators over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialmesh.functions.phones import format_international
from dialmesh.operators.phones import (
    dedup_phones,
    label_phones,
    phone_rejects,
    sanitize_phones,
    text_phones,
    validate_phones,
)

from .base import query, table

PATTERN = r"(\+\d{1,2}\s)?[\s.-]*\(?\d{3}\)?[\s.-]*\d{3}[\s.-]*\d{4}"
BLANKS = "E' \\t\\n\\r\\f'"


# Area codes in use, by first and second digit (fixed values, kept apart from the library's).
AREA_CODES = "|".join([
    "20[123456789]|21[023456789]|22[03456789]|23[14569]|24[02689]|25[0123467]|26[0234789]|27[023469]|28[1349]",
    "30[123456789]|31[023456789]|32[01345679]|33[0124679]|34[013567]|35[012347]|36[01345789]|38[02567]",
    "40[123456789]|41[023456789]|42[3458]|43[01245678]|44[0123578]|45[078]|46[034589]|47[01234589]|48[034]",
    "50[0123456789]|51[023456789]|52[0123456789]|53[01349]|54[0148]|55[179]|56[123467]|57[01234579]|58[01245678]",
    "60[0123456789]|61[023456789]|62[01234689]|63[01369]|64[0145679]|65[0156789]|66[012479]|67[012789]|68[01234689]",
    "70[123456789]|71[023456789]|72[01456789]|73[012478]|74[02378]|75[3478]|76[023579]|77[01234589]|78[0124567]",
    "80[0123456789]|81[023456789]|82[015689]|83[01235789]|84[0345789]|85[01456789]|86[0123456789]|87[023678]|88[8]",
    "90[0123456789]|91[023456789]|92[04589]|93[0146789]|94[01235789]|95[12469]|97[0123589]|98[034569]",
])


def validated(source: str) -> str:
    """SQL over ``source(…, number)`` that adds valid_number and error."""
    return f"""
    SELECT * EXCLUDE (digits, nat, plus, area),
           CASE WHEN ok THEN '+1 ' || nat[1:3] || '-' || nat[4:6] || '-' || nat[7:10] END AS valid_number,
           CASE WHEN NOT ok THEN CASE WHEN plus AND digits[1] <> '1' THEN 'unsupported_country'
                                      ELSE 'invalid_number' END END AS error
    FROM (
      SELECT *, regexp_matches(nat, '^[2-9][0-9]{{2}}[2-9][0-9]{{6}}$')
                AND NOT (plus AND digits[1] <> '1')
                AND regexp_matches(area, '^({AREA_CODES})$') AS ok
      FROM (
        SELECT *, regexp_replace(digits, '^1', '') AS nat, regexp_replace(digits, '^1', '')[1:3] AS area
        FROM (
          SELECT *, regexp_replace(number, '[^0-9]', '', 'g') AS digits,
                 regexp_matches(number, '^[^0-9]*\\+') AS plus
          FROM ({source})
        )
      )
    )
    """


DOC_PHONES = f"""
  SELECT doc_id, source, (i - 1)::INT AS pos, ltrim(m[i], {BLANKS}) AS number, 0 AS confidence
  FROM (
    SELECT doc_id, source, m, unnest(range(1, len(m) + 1)) AS i
    FROM (SELECT doc_id, source, regexp_extract_all(text, '{PATTERN}') AS m FROM documents)
  )
"""

# The documents never say "phone", so the word is put before each run of ten digits.
# A match is then preceded by the word exactly when it stands right in front.
MARKED_PHONES = f"""
  SELECT doc_id, source, (i - 1)::INT AS pos,
         ltrim(regexp_replace(m[i], '^telephone', ''), {BLANKS}) AS number,
         (m[i] LIKE 'telephone%')::INT AS confidence
  FROM (
    SELECT doc_id, source, m, unnest(range(1, len(m) + 1)) AS i
    FROM (
      SELECT doc_id, source,
             regexp_extract_all(regexp_replace(text, '([0-9]{{10}})', ' telephone \\1', 'g'),
                                '(?:telephone)?{PATTERN}') AS m
      FROM documents
    )
  )
"""


def doc_phones(spark, sf_dir):
    return text_phones(table(spark, sf_dir, "documents"), ["doc_id", "source"])


def marked_phones(spark, sf_dir):
    marked = table(spark, sf_dir, "documents").withColumn(
        "text", F.regexp_replace("text", "([0-9]{10})", " telephone $1")
    )
    return text_phones(marked, ["doc_id", "source"])


@query("match_phones", DOC_PHONES)
def match_phones_query(spark, sf_dir):
    return doc_phones(spark, sf_dir)


@query("phone_prefix_confidence", MARKED_PHONES)
def phone_prefix_confidence_query(spark, sf_dir):
    return marked_phones(spark, sf_dir)


@query(
    "validate_phones",
    f"SELECT doc_id, pos, number, valid_number, error FROM ({validated(DOC_PHONES)})",
)
def validate_phones_query(spark, sf_dir):
    return validate_phones(doc_phones(spark, sf_dir)).select(
        "doc_id", "pos", "number", "valid_number", "error"
    )


@query(
    "format_international",
    """
    SELECT c_custkey, '+1 541-' || (200 + c_custkey % 800) || '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0')
           AS number
    FROM customer
    """,
)
def format_international_query(spark, sf_dir):
    digits = F.concat(
        F.lit("541"),
        (200 + F.col("c_custkey") % 800).cast("string"),
        F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"),
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", format_international(digits).alias("number")
    )


@query(
    "phone_rejects",
    f"""
    SELECT doc_id, pos AS idx, number, error AS reason
    FROM ({validated(DOC_PHONES)}) WHERE error IS NOT NULL
    """,
)
def phone_rejects_query(spark, sf_dir):
    return phone_rejects(doc_phones(spark, sf_dir), ["doc_id"])


_VALID_MARKED = f"""
    SELECT source, doc_id, pos, valid_number AS number, confidence
    FROM ({validated(MARKED_PHONES)}) WHERE error IS NULL
"""


def _dedup_sql(rows: str) -> str:
    return f"""
    SELECT source, number, max(confidence) AS confidence,
           min(doc_id) AS doc_id, arg_min(pos, (doc_id * 1000000 + pos)) AS pos
    FROM ({rows}) GROUP BY source, number
    """


@query("dedup_phones", _dedup_sql(MARKED_PHONES))
def dedup_phones_query(spark, sf_dir):
    return dedup_phones(marked_phones(spark, sf_dir), ["source"], ["doc_id", "pos"])


@query("sanitize_phones", _dedup_sql(_VALID_MARKED))
def sanitize_phones_query(spark, sf_dir):
    return sanitize_phones(marked_phones(spark, sf_dir), ["source"], ["doc_id", "pos"])


@query(
    "confidence_label",
    f"""
    SELECT doc_id, pos, CASE confidence WHEN 0 THEN 'regex match'
                            WHEN 1 THEN 'regex match with ''phone'' prefix'
                            WHEN 2 THEN 'a[href="tel:< phone number >"]' ELSE 'unknown' END AS label
    FROM (SELECT doc_id, pos, confidence + CASE WHEN pos % 3 = 2 THEN 1 ELSE 0 END AS confidence
          FROM ({MARKED_PHONES}))
    """,
)
def confidence_label_query(spark, sf_dir):
    raised = marked_phones(spark, sf_dir).withColumn(
        "confidence", F.col("confidence") + F.when(F.col("pos") % 3 == 2, 1).otherwise(0)
    )
    return label_phones(raised).select("doc_id", "pos", "label")
