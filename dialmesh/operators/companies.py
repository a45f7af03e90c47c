"""Company rows by key: lookup, whole-record upsert, partial update.

Store schema: ``id, domain, commercial_name, legal_name, all_available_names,
phone_numbers``.  The operators are pure; ``sources.company_table`` persists them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import add_once
from ..functions.urls import company_id, parse_url_checked
from ..joins import lookup_join

NOT_FOUND = "not_found"
INVALID_PARAMS = "invalid_params"

STRING_FIELDS = ["domain", "commercial_name", "legal_name"]
LIST_FIELDS = ["all_available_names", "phone_numbers"]
FIELDS = STRING_FIELDS + LIST_FIELDS
STORE_COLUMNS = ["id"] + FIELDS
STORE_SCHEMA = ", ".join(
    ["id string"]
    + [f"{name} string" for name in STRING_FIELDS]
    + [f"{name} array<string>" for name in LIST_FIELDS]
)


def as_store_rows(companies: DataFrame, *extra: Column) -> DataFrame:
    """Any company rows in store shape (plus ``extra`` columns); the id comes from the
    domain when absent and absent fields are NULL."""
    have = set(companies.columns)
    if "id" not in have:
        companies = add_once(companies, "id", company_id("domain"))
    fields = [
        F.col(name)
        if name in have
        else F.lit(None).cast("array<string>" if name in LIST_FIELDS else "string").alias(name)
        for name in FIELDS
    ]
    return companies.select("id", *fields, *extra)


def upsert_companies(store: DataFrame, companies: DataFrame, order: list[str]) -> DataFrame:
    """Whole-record upsert: the last row per id (by ``order``) replaces the stored one,
    phone numbers included.  ``max_by`` combines before the shuffle, so a key with
    many copies costs one row per task; one full join then says which side wins."""
    last = (
        as_store_rows(companies, F.struct(*order).alias("_order"))
        .where("id is not null")
        .groupBy("id")
        .agg(F.max_by(F.struct(*FIELDS), "_order").alias("_c"))
        .select("id", "_c.*")
    )
    imported = last.select("id", F.struct(*FIELDS).alias("_new"))
    both = store.select(*STORE_COLUMNS).join(imported, "id", "full_outer")
    fields = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{n}")).otherwise(F.col(n)).alias(n) for n in FIELDS]
    return both.select("id", *fields)


def import_stats(rows: DataFrame) -> DataFrame:
    """One row ``flushed, failed`` from rows with an ``error`` column."""
    return rows.agg(
        F.count_if(F.col("error").isNull()).alias("flushed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def get_companies(store: DataFrame, urls: DataFrame) -> DataFrame:
    """Batch lookup of ``urls(url)``: the store's columns plus ``error`` (a URL error
    code, or ``not_found``)."""
    keyed = add_once(urls.select("url"), "_p", parse_url_checked("url")).select(
        "url", F.col("_p.hostname").alias("id"), F.col("_p.error").alias("_bad")
    )
    # Bad URLs have no key; a stand-in of their own keeps them off one NULL partition.
    keyed = keyed.withColumn("_key", F.coalesce("id", F.concat(F.lit("#"), F.col("url"))))
    stored = store.select(F.col("id").alias("_key"), *FIELDS, F.lit(True).alias("_hit"))
    return lookup_join(keyed, stored, "_key", "left", urls.count()).select(
        "url",
        "id",
        *FIELDS,
        F.coalesce("_bad", F.when(F.col("_hit").isNull(), F.lit(NOT_FOUND))).alias("error"),
    )


def get_company(store: DataFrame, url: str) -> DataFrame:
    """The one row of a URL or bare domain; no row when it is not stored.

    The key is worked out first, so that the filter on it reaches the files.
    Raises ``ValueError`` for a bad URL.
    """
    asked = store.sparkSession.createDataFrame([(url,)], "url string")
    key = asked.select(parse_url_checked("url").alias("p")).first()["p"]
    if key["error"]:
        raise ValueError(key["error"])
    return store.where(F.col("id") == key["hostname"])


@dataclass(frozen=True)
class UpdateResult:
    store: DataFrame
    rejects: DataFrame  # url, error


def update_companies(store: DataFrame, updates: DataFrame, order: str | None = None) -> UpdateResult:
    """Partial merge of ``updates(url, <some fields>)`` into the store.

    A field that is present and not NULL overwrites, the others stay; lists are
    replaced.  Of several updates of a company the last by ``order`` wins per field.
    Unknown ids and bad URLs come back as rejects.
    """
    given = [name for name in FIELDS if name in updates.columns]
    keyed = add_once(updates, "_p", parse_url_checked("url")).withColumn("id", F.col("_p.hostname"))
    # in a struct, so that an update without an order is the earliest and not lost
    rank = F.struct(order) if order else F.struct("url", *given)

    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), rank)).alias(f"_new_{name}")

    merged = keyed.where("id is not null").groupBy("id").agg(*[last(n) for n in given])
    updated = store.join(merged, "id", "left").select(
        "id",
        *[
            F.coalesce(f"_new_{n}", n).alias(n) if n in given else F.col(n)
            for n in FIELDS
        ],
    )
    return UpdateResult(updated, _update_rejects(store, keyed))


def _update_rejects(store: DataFrame, keyed: DataFrame) -> DataFrame:
    bad = keyed.where("id is null").select("url", F.col("_p.error").alias("error"))
    known = store.select("id", F.lit(True).alias("_hit"))
    asked = keyed.where("id is not null").select("id", "url")
    missing = lookup_join(asked, known, "id", "left").where("_hit is null")
    missing = missing.select("url", F.lit(NOT_FOUND).alias("error"))
    return bad.unionByName(missing)


def _value_problem() -> Column:
    """Why a (field, value_json) pair cannot be applied, NULL when it can."""
    value = F.col("value_json")
    wrapped = F.from_json(
        F.concat(F.lit('{"v":'), value, F.lit("}")), "v string, _bad string",
        {"columnNameOfCorruptRecord": "_bad"},
    )
    is_null = value.rlike(r"^\s*null\s*$")
    fits = (
        F.when(F.col("field").isin(STRING_FIELDS), value.rlike(r'^\s*"'))
        .when(
            F.col("field").isin(LIST_FIELDS),
            value.rlike(r'(?s)^\s*\[\s*(?:"(?:[^"\\]|\\.)*+"\s*(?:,\s*(?="))?+)*+\]\s*$'),
        )
        .otherwise(False)
    )
    known = F.col("field").isin(FIELDS)
    parses = wrapped.isNotNull() & wrapped["_bad"].isNull()
    return F.when(
        ~F.coalesce(known & parses & (fits | is_null), F.lit(False)), F.lit(INVALID_PARAMS)
    )


def update_fields(store: DataFrame, changes: DataFrame, order: str) -> UpdateResult:
    """Single-field updates ``(url, field, value_json, <order>)``; JSON null clears the
    field.  Unknown fields and unfit values are ``invalid_params`` rejects."""
    checked = F.struct(parse_url_checked("url").alias("url"), _value_problem().alias("problem"))
    keyed = (
        add_once(changes, "_c", checked)
        .withColumn("_p", F.col("_c.url"))
        .withColumn("id", F.col("_p.hostname"))
        .withColumn("_problem", F.col("_c.problem"))
    )
    good = keyed.where("_problem is null and id is not null")
    # One value per (id, field): the field list is fixed, so these are plain columns.
    last = good.groupBy("id").agg(
        *[
            F.max_by("value_json", F.when(F.col("field") == name, F.col(order))).alias(f"_new_{name}")
            for name in FIELDS
        ]
    )

    def parsed(name: str) -> Column:
        kind = "array<string>" if name in LIST_FIELDS else "string"
        text = F.concat(F.lit('{"v":'), F.col(f"_new_{name}"), F.lit("}"))
        return F.from_json(text, f"v {kind}")["v"]

    updated = store.join(last, "id", "left").select(
        "id",
        *[
            F.when(F.col(f"_new_{n}").isNotNull(), parsed(n)).otherwise(F.col(n)).alias(n)
            for n in FIELDS
        ],
    )
    unfit = keyed.where("_problem is not null").select("url", F.col("_problem").alias("error"))
    rejects = unfit.unionByName(_update_rejects(store, keyed.where("_problem is null")))
    return UpdateResult(updated, rejects)
