"""Search of the company store: ranked by name (BM25), exact by phone.

Searches are batches: ``queries(query_id, name)`` or ``queries(query_id, phone)``.
A batch that is small (checked) is broadcast to the postings, which are dealt by company
before they meet it where many scores come of them; a larger one is joined on (term, salt),
so a term that a third of the companies share spreads over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..frames import add_once
from ..functions.names import name_tokens, term_counts
from ..functions.phones import validate_phone
from ..joins import lookup_join
from ..session import is_small, materialize
from .companies import INVALID_PARAMS, STORE_COLUMNS

NAME_FIELDS = ["commercial_name", "legal_name", "all_available_names"]
K1 = 1.2
B = 0.75
PAGE_SIZE = 10
SCORE_DIGITS = 6
BROADCAST_TERMS = 200_000
SALTS = 32
TASK_PARTS = 500_000  # scores of a term in a name that one task adds up
MAX_DEALT = 200  # up to so many partitions a shuffle writes rows as they come, none kept in memory


@dataclass(frozen=True)
class NameIndex:
    """``postings(term, field, id, tf, len)``, ``terms(term, field, df)`` and
    ``fields(field, n_docs, avg_len)`` (three rows)."""

    postings: DataFrame
    terms: DataFrame
    fields: DataFrame

    def save(self, path: str) -> None:
        """Postings sorted by term over range partitions: a frequent term is cut by
        id into several files, and row-group statistics prune a search by term."""
        (
            self.postings.repartitionByRange("term", "id")
            .sortWithinPartitions("term", "id")
            .write.mode("overwrite")
            .parquet(f"{path}/postings")
        )
        saved = self.postings.sparkSession.read.schema(self.postings.schema).parquet(
            f"{path}/postings"
        )
        term_stats(saved).write.mode("overwrite").parquet(f"{path}/terms")
        self.fields.write.mode("overwrite").parquet(f"{path}/fields")

    @staticmethod
    def load(spark: SparkSession, path: str) -> NameIndex:
        return NameIndex(*[spark.read.parquet(f"{path}/{n}") for n in ("postings", "terms", "fields")])


def tokenize_names(store: DataFrame) -> DataFrame:
    """Postings ``term, field, id, tf, len``; a list field is one bag of words.

    Counted inside the row, so tokenising does not shuffle.
    """
    texts = {
        "commercial_name": F.col("commercial_name"),
        "legal_name": F.col("legal_name"),
        "all_available_names": F.array_join("all_available_names", "\n"),
    }
    bags = F.array(
        *[F.struct(F.lit(f).alias("field"), name_tokens(t).alias("tokens")) for f, t in texts.items()]
    )
    per_field = store.select("id", F.explode(bags).alias("_b")).select(
        "id", "_b.field", "_b.tokens", F.size("_b.tokens").alias("len")
    )
    return per_field.select(
        "id", "field", "len", F.explode(term_counts(F.col("tokens"))).alias("_t")
    ).select("_t.term", "field", "id", "_t.tf", "len")


def term_stats(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term", "field").agg(F.count(F.lit(1)).alias("df"))


def field_stats(store: DataFrame) -> DataFrame:
    """Documents with at least one term in the field, and their mean length."""
    lengths = {
        "commercial_name": F.size(name_tokens("commercial_name")),
        "legal_name": F.size(name_tokens("legal_name")),
        "all_available_names": F.size(name_tokens(F.array_join("all_available_names", "\n"))),
    }
    sizes = store.select(
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("field"), n.alias("len")) for f, n in lengths.items()])
        ).alias("_s")
    ).select("_s.*")
    return (
        sizes.where("len > 0")
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("avg_len"))
    )


def name_index(store: DataFrame) -> NameIndex:
    postings = tokenize_names(store)
    return NameIndex(postings, term_stats(postings), field_stats(store))


def join_on_hot_key(
    big: DataFrame, small: DataFrame, key: str, broadcast: bool, salt: str = "id"
) -> DataFrame:
    """Equi-join that stays even when one key holds much of ``big``, dealt by ``salt``."""
    if broadcast:
        return big.join(F.broadcast(small), key)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (
        big.withColumn("_salt", F.pmod(F.hash(salt), F.lit(SALTS)))
        .join(salted, [key, "_salt"])
        .drop("_salt")
    )


def search_sort(hits: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Best ``page_size`` hits per query: score descending, then id.

    The rank filter becomes a per-task limit before the shuffle.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= page_size)


def term_idf(terms: DataFrame, fields: DataFrame, wanted: DataFrame) -> DataFrame:
    """``term, field, avg_len, df, idf`` of the wanted terms."""
    fields = F.broadcast(fields)  # one row per name field: three rows
    return (
        terms.join(wanted.select("term").distinct(), "term", "left_semi")
        .join(fields, "field")
        .select(
            "term",
            "field",
            "avg_len",
            "df",
            F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"),
        )
    )


def name_hits(index: NameIndex, queries: DataFrame) -> DataFrame:
    """``query_id, id, score`` of every company with at least one query term."""
    wanted = (
        queries.select("query_id", F.explode(name_tokens("name")).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    idf = term_idf(index.terms, index.fields, wanted)
    weighted = materialize(wanted.join(idf, "term"))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len"))
    part = F.col("weight") * F.col("idf") * F.col("tf") * (K1 + 1) / norm
    postings = index.postings.withColumnRenamed("field", "_field")
    # At most one weighted row per wanted term and name field.
    broadcast = is_small(wanted, BROADCAST_TERMS)
    if broadcast:
        postings = _dealt(postings, weighted)
    joined = join_on_hot_key(postings, weighted.drop("df"), "term", broadcast)
    scored = joined.where(F.col("_field") == F.col("field")).select(
        "query_id", "id", "field", part.alias("part")
    )
    best = F.greatest(
        *[F.sum(F.when(F.col("field") == f, F.col("part"))) for f in NAME_FIELDS]
    )  # greatest skips NULLs
    return scored.groupBy("query_id", "id").agg(F.round(best, SCORE_DIGITS).alias("score"))


def _dealt(postings: DataFrame, weighted: DataFrame) -> DataFrame:
    """Postings of the wanted terms by company, in partitions of about ``TASK_PARTS`` scores.

    A scan of a small file is one task, whose companies may have scores for every query; so
    few scores stay in the tasks of the scan.
    """
    parts = weighted.agg(F.sum("df")).first()[0] or 0  # each query meets each posting of its terms
    if parts <= TASK_PARTS:
        return postings
    usual = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_DEALT, max(usual, -(-int(parts) // TASK_PARTS)))
    terms = F.broadcast(weighted.select("term", F.col("field").alias("_field")).distinct())
    return postings.join(terms, ["term", "_field"], "left_semi").repartition(n, "id")


def asked_numbers(queries: DataFrame) -> DataFrame:
    """``query_id, number`` of the queries whose number validates."""
    checked = add_once(queries.select("query_id", "phone"), "_v", validate_phone("phone"))
    return checked.select("query_id", F.col("_v.number").alias("number")).where("number is not null")


def number_hits(listed: DataFrame, asked: DataFrame) -> DataFrame:
    """``query_id, id, score`` with each distinct number of ``asked(number)`` as ``query_id``;
    ``listed`` has ``number, id``, pairs once."""
    numbers = asked.select("number").distinct()
    hits = join_on_hot_key(listed, numbers, "number", is_small(numbers, BROADCAST_TERMS))
    return hits.select(F.col("number").alias("query_id"), "id", F.lit(1.0).alias("score"))


def phone_hits(store: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, id, score`` of the companies that list the query's number."""
    wanted = asked_numbers(queries)
    numbers = store.select("id", F.explode(F.array_distinct("phone_numbers")).alias("number"))
    return join_on_hot_key(numbers, wanted, "number", is_small(wanted, BROADCAST_TERMS)).select(
        "query_id", "id", F.lit(1.0).alias("score")
    )


def ranked_page(hits: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The best hits per query with ``total``, which counts all hits, not only those returned.

    Counting the score keeps both uses of the hits on one shuffle.
    """
    totals = hits.groupBy("query_id").agg(F.count("score").alias("total"))
    return search_sort(hits, page_size).join(totals, "query_id")


def search_result(hits: DataFrame, store: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``query_id, total, rank, score`` and the company's columns."""
    return store.select(*STORE_COLUMNS).join(ranked_page(hits, page_size), "id").select(
        "query_id", "total", "rank", "score", *STORE_COLUMNS
    )


def search_phones(store: DataFrame, queries: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``search_result`` of ``queries(query_id, phone)``; each distinct number is looked up once.

    A number that thousands of queries ask for is counted and ranked once; only its best
    rows meet the queries.  ``CompanyStore.search_phones`` reads stored numbers instead of
    all companies.
    """
    asked = asked_numbers(queries)
    numbers = asked.select(F.col("number").alias("query_id"), F.col("number").alias("phone")).distinct()
    found = search_result(phone_hits(store, numbers), store, page_size)
    # at most page_size rows per number
    return lookup_join(asked, materialize(found.withColumnRenamed("query_id", "number")), "number").drop("number")


def search_by_name(store: DataFrame, name: str, index: NameIndex | None = None) -> DataFrame:
    queries = store.sparkSession.createDataFrame([(0, name)], "query_id int, name string")
    hits = name_hits(index or name_index(store), queries)
    return search_result(hits, store).drop("query_id").orderBy("rank")


def search_by_phone(store: DataFrame, phone: str) -> DataFrame:
    """Raises ``ValueError`` for a number that does not validate."""
    queries = store.sparkSession.createDataFrame([(0, phone)], "query_id int, phone string")
    error = queries.select(validate_phone("phone")["error"].alias("error")).first()["error"]
    if error:
        raise ValueError(error)
    return search_result(phone_hits(store, queries), store).drop("query_id").orderBy("rank")


def search_company(store: DataFrame, name: str = "", phone: str = "", index: NameIndex | None = None):
    """Exactly one of ``name`` and ``phone`` must be given."""
    if bool(name) == bool(phone):
        raise ValueError(INVALID_PARAMS)
    return search_by_phone(store, phone) if phone else search_by_name(store, name, index)


def query_error() -> Column:
    """Why a (name, phone) query cannot run, NULL when it can."""
    name = F.coalesce("name", F.lit("")) != ""
    phone = F.coalesce("phone", F.lit("")) != ""
    return F.when(name == phone, F.lit(INVALID_PARAMS)).when(phone, validate_phone("phone")["error"])


def search_companies(store: DataFrame, queries: DataFrame, index: NameIndex | None = None):
    """Batch dispatch of ``queries(query_id, name, phone)``.

    Gives the ranked results and the queries' ``query_id, error`` (``not_found`` for
    a query without hits).  Each distinct search runs once, however many queries
    ask it.
    """
    checked = add_once(
        queries, "_c", F.struct(query_error().alias("error"), validate_phone("phone")["number"].alias("number"))
    )
    # "n:" and "p:" tell names from numbers; a bad query gets a key of its own, which
    # keeps such queries off one NULL partition.
    keyed = checked.select(
        "query_id",
        F.col("_c.error").alias("error"),
        F.when(F.col("_c.error").isNotNull(), F.concat(F.lit("#"), F.col("query_id").cast("string")))
        .when(F.col("_c.number").isNotNull(), F.concat(F.lit("p:"), F.col("_c.number")))
        .otherwise(F.concat(F.lit("n:"), F.col("name")))
        .alias("search"),
    )
    searches = keyed.where("error is null").select(F.col("search").alias("query_id")).distinct()
    text = F.substr("query_id", F.lit(3))
    by_name = searches.where(F.col("query_id").startswith("n:")).select("query_id", text.alias("name"))
    by_phone = searches.where(F.col("query_id").startswith("p:")).select("query_id", text.alias("phone"))
    hits = name_hits(index or name_index(store), by_name).unionByName(phone_hits(store, by_phone))
    found = materialize(search_result(hits, store).withColumnRenamed("query_id", "search"))
    answered = found.where("rank = 1").select("search", F.lit(True).alias("_hit"))
    asked = queries.count()
    status = lookup_join(keyed, answered, "search", "left", asked).select(
        "query_id",
        F.coalesce("error", F.when(F.col("_hit").isNull(), F.lit("not_found"))).alias("error"),
    )
    results = lookup_join(keyed.select("query_id", "search"), found, "search", rows=asked).drop(
        "search"
    )
    return results, status
