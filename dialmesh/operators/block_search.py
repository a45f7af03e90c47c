"""Ranked search by name that scores only companies which can reach the page.

Companies are numbered in the order of their names and lie in blocks of ``BLOCK`` numbers.
The index knows, per term, field and block, the largest count and the shortest field, hence
what the term can add to a score there at most; that holds whatever the statistics are.  A
search adds these up per block, scores the most promising blocks, and then only those whose
limit reaches the last place of the page found so far.  All of a company's terms lie in its
block, so scores are whole and the result is the one of scoring every hit.

Totals come from bitmaps of the companies that have a term: their union per query is
counted, no row per hit is made.

An index is kept up by ``NameChanges``: the names that went and those that came since it was
built.  Statistics are corrected by both, blocks keep their limits (which can only be too
high), companies that went are taken out of the hits and those that came are scored beside.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import name_tokens
from ..session import is_small, materialize
from .companies import STORE_COLUMNS
from .search import (
    B,
    BROADCAST_TERMS,
    K1,
    NAME_FIELDS,
    PAGE_SIZE,
    SCORE_DIGITS,
    field_stats,
    join_on_hot_key,
    search_sort,
    term_idf,
    term_stats,
    tokenize_names,
)

BLOCK = 128  # companies; a power of two, as numbers of a partition start at multiples of one
PARTS = ("postings", "blocks", "bitmaps", "terms", "fields")
#: More than sums of doubles in another order differ, far less than the last digit of a score.
SLACK = 1e-9


@dataclass(frozen=True)
class BlockIndex:
    """``postings(term, field, block, id, tf, len)``, ``blocks(term, field, block, max_tf,
    min_len, min_id)``, ``bitmaps(term, bucket, bits)``, ``terms(term, field, df)`` and
    ``fields(field, n_docs, avg_len)``, sorted by term, so that a search reads its terms."""

    postings: DataFrame
    blocks: DataFrame
    bitmaps: DataFrame
    terms: DataFrame
    fields: DataFrame

    @staticmethod
    def build(store: DataFrame, path: str) -> BlockIndex:
        spark = store.sparkSession
        order = ["commercial_name", "legal_name", "id"]
        sorted_store = store.repartitionByRange(*order).sortWithinPartitions(*order)
        numbered = materialize(sorted_store.withColumn("id", F.struct(F.monotonically_increasing_id().alias("no"), "id")))
        found = tokenize_names(numbered).select("term", "field", F.col("id.no").alias("no"), "id.id", "tf", "len")
        postings = found.withColumn("block", F.shiftright("no", BLOCK.bit_length() - 1))
        _save(postings, f"{path}/postings", "term", "field", "no")
        postings = spark.read.parquet(f"{path}/postings")
        blocks = postings.groupBy("term", "field", "block").agg(
            F.max("tf").alias("max_tf"), F.min("len").alias("min_len"), F.min("id").alias("min_id")
        )
        _save(blocks, f"{path}/blocks", "term", "field", "block")
        place = F.bitmap_bit_position("no")
        bitmaps = postings.groupBy("term", F.bitmap_bucket_number("no").alias("bucket")).agg(
            F.bitmap_construct_agg(place).alias("bits")
        )
        _save(bitmaps, f"{path}/bitmaps", "term", "bucket")
        _save(term_stats(postings), f"{path}/terms", "term", "field")
        field_stats(store).write.mode("overwrite").parquet(f"{path}/fields")
        return BlockIndex.load(spark, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BlockIndex:
        return BlockIndex(*[spark.read.parquet(f"{path}/{name}") for name in PARTS])


@dataclass(frozen=True)
class NameChanges:
    """``went`` and ``came``: postings of names that left and joined the store since the index
    was built, each company once a side."""

    went: DataFrame
    came: DataFrame

    @staticmethod
    def between(before: DataFrame, after: DataFrame) -> DataFrame:
        """``id``, its names and ``by`` (-1 went, 1 came) of the companies whose names differ."""
        sides = [rows.select("id", *NAME_FIELDS, F.lit(by).alias("by")) for rows, by in ((before, -1), (after, 1))]
        return NameChanges.settled(sides[0].unionByName(sides[1]))

    @staticmethod
    def settled(changes: DataFrame) -> DataFrame:
        """What is left of changes in a row: names that came and went again cancel."""
        return changes.groupBy("id", *NAME_FIELDS).agg(F.sum("by").cast("int").alias("by")).where("by <> 0")

    @staticmethod
    def load(changes: DataFrame) -> NameChanges:
        """From all rows of ``between`` since the index was built."""
        left = materialize(NameChanges.settled(changes))
        return NameChanges(*[materialize(tokenize_names(left.where(F.col("by") == by))) for by in (-1, 1)])

    def signed(self) -> DataFrame:
        """Both sides, with ``by``."""
        sides = [side.withColumn("by", F.lit(by)) for side, by in ((self.went, -1), (self.came, 1))]
        return sides[0].unionByName(sides[1])

    def applied(self, index: BlockIndex, terms: DataFrame) -> BlockIndex:
        """The index with the statistics of now, for the given ``term``s only."""
        terms = terms.select("term").distinct()
        listed = index.terms.unionByName(self.signed().select("term", "field", F.col("by").cast("long").alias("df")))
        counted = listed.join(terms, "term", "left_semi").groupBy("term", "field").agg(F.sum("df").alias("df"))
        by_company = self.signed().groupBy("field", "id", "by").agg(F.max("len").alias("len"))
        moved = by_company.groupBy("field").agg(F.sum("by").alias("n_docs"), F.sum(F.col("by") * F.col("len")).alias("words"))
        # means of whole numbers, so their sums can be had back exactly
        base = index.fields.select("field", "n_docs", F.round(F.col("n_docs") * F.col("avg_len")).cast("long").alias("words"))
        sums = base.unionByName(moved).groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("words").alias("words"))
        fields = sums.where("n_docs > 0").select("field", "n_docs", (F.col("words") / F.col("n_docs")).alias("avg_len"))
        return replace(index, terms=counted.where("df > 0"), fields=materialize(fields))


def _save(df: DataFrame, path: str, *order: str) -> None:
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def _wanted(queries: DataFrame) -> DataFrame:
    terms = queries.select("query_id", F.explode(name_tokens("name")).alias("term"))
    return terms.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("weight"))


def _weighted(index: BlockIndex, wanted: DataFrame) -> DataFrame:
    """``query_id, term, field, avg_len, weight``, the weight with the term's rarity in it."""
    idf = term_idf(index.terms, index.fields, wanted)
    return wanted.join(idf, "term").select(
        "query_id", "term", "field", "avg_len", (F.col("weight") * F.col("idf")).alias("weight")
    )


def _score(tf: str, length: str) -> Column:
    norm = F.col(tf) + K1 * (1 - B + B * F.col(length) / F.col("avg_len"))
    part = F.col("weight") * F.col(tf) * (K1 + 1) / norm
    return F.greatest(*[F.sum(F.when(F.col("field") == f, part)) for f in NAME_FIELDS])  # skips NULLs


def block_limits(index: BlockIndex, weighted: DataFrame) -> DataFrame:
    """``query_id, block, limit, min_id``: no company of the block scores above ``limit``."""
    terms = weighted.withColumnRenamed("field", "_field")
    small = is_small(weighted, BROADCAST_TERMS)
    joined = join_on_hot_key(index.blocks, terms, "term", small, salt="block").where("field = _field")
    limit = F.round(_score("max_tf", "min_len") + SLACK, SCORE_DIGITS).alias("limit")
    return joined.groupBy("query_id", "block").agg(limit, F.min("min_id").alias("min_id"))


def _hits_in(index: BlockIndex, weighted: DataFrame, blocks: DataFrame) -> DataFrame:
    """``query_id, id, score`` of the hits in ``blocks(query_id, block)``."""
    asked = blocks.select("query_id", "block").join(weighted, "query_id")
    keys = ["term", "field", "block"]
    asked = F.broadcast(asked) if is_small(asked, BROADCAST_TERMS) else asked
    scored = index.postings.join(asked, keys)
    return scored.groupBy("query_id", "id").agg(F.round(_score("tf", "len"), SCORE_DIGITS).alias("score"))


def _new_hits(changes: NameChanges, weighted: DataFrame) -> DataFrame:
    """``query_id, id, score`` of the hits among the names that came."""
    terms = weighted.withColumnRenamed("field", "_field")
    joined = join_on_hot_key(changes.came, terms, "term", is_small(weighted, BROADCAST_TERMS)).where("field = _field")
    return joined.groupBy("query_id", "id").agg(F.round(_score("tf", "len"), SCORE_DIGITS).alias("score"))


def open_blocks(limits: DataFrame, hits: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Blocks that can hold a company before the last one of a page of ``hits``.

    Equal scores are ordered by id, so a block whose limit is the last score counts only if
    it has an id before the last one's.
    """
    last = search_sort(hits, page_size).where(F.col("rank") == page_size)
    last = last.select("query_id", F.col("score").alias("_score"), F.col("id").alias("_id"))
    reach = F.col("_score").isNull() | (F.col("limit") > F.col("_score"))
    tie = (F.col("limit") == F.col("_score")) & (F.col("min_id") < F.col("_id"))
    return limits.join(last, "query_id", "left").where(reach | tie).select("query_id", "block")


def best_hits(
    index: BlockIndex, queries: DataFrame, page_size: int = PAGE_SIZE, changes: NameChanges | None = None
) -> DataFrame:
    """``query_id, id, score, rank``: the page of each of ``queries(query_id, name)``."""
    wanted = _wanted(queries)
    index = changes.applied(index, wanted) if changes else index
    weighted = materialize(_weighted(index, wanted))
    limits = materialize(block_limits(index, weighted))
    order = Window.partitionBy("query_id").orderBy(F.desc("limit"), "min_id", "block")
    # every block has a hit, unless it went, so as many blocks as places fill the page
    first = limits.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= page_size)
    first = materialize(first.select("query_id", "block"))
    gone = changes.went.select("id").distinct() if changes else None

    def hits_in(blocks: DataFrame) -> DataFrame:
        hits = _hits_in(index, weighted, blocks)
        return hits.join(gone, "id", "left_anti") if changes else hits

    found = hits_in(first)
    found = materialize(found.unionByName(_new_hits(changes, weighted)) if changes else found)
    more = materialize(open_blocks(limits.join(first, ["query_id", "block"], "left_anti"), found, page_size))
    return search_sort(found.unionByName(hits_in(more)), page_size)


def search_totals(index: BlockIndex, queries: DataFrame, changes: NameChanges | None = None) -> DataFrame:
    """``query_id, total``: how many companies each query finds; no row for none."""
    wanted = _wanted(queries).select("query_id", "term")
    small = is_small(wanted, BROADCAST_TERMS)
    joined = join_on_hot_key(index.bitmaps, wanted, "term", small, salt="bucket")
    union = joined.groupBy("query_id", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    totals = union.groupBy("query_id").agg(F.sum(F.bitmap_count("bits")).alias("total"))
    if not changes:
        return totals
    moved = join_on_hot_key(changes.signed(), wanted, "term", small).groupBy("query_id", "id", "by").agg(F.lit(1).alias("_one"))
    moved = moved.groupBy("query_id").agg(F.sum("by").alias("total"))
    both = totals.unionByName(moved).groupBy("query_id").agg(F.sum("total").alias("total"))
    return both.where("total > 0")


def search_names(
    index: BlockIndex,
    store: DataFrame,
    queries: DataFrame,
    page_size: int = PAGE_SIZE,
    changes: NameChanges | None = None,
) -> DataFrame:
    """``query_id, total, rank, score`` and the company's columns, as ``search_result`` has them."""
    page = best_hits(index, queries, page_size, changes).join(search_totals(index, queries, changes), "query_id")
    # rows of the pages only
    return store.select(*STORE_COLUMNS).join(materialize(page), "id").select(
        "query_id", "total", "rank", "score", *STORE_COLUMNS
    )
