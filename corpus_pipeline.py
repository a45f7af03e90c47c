"""From raw documents to packed sequences: five operators of ``dialmesh.llm`` in a row.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; the
stages before the last return the columns of ``docs``.  Null texts count as empty and are
kept; tables without rows, and extra columns of any name, pass through.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialmesh.joins import BloomFilter
from dialmesh.llm import queries
from dialmesh.llm.common import table
from dialmesh.llm.minhash_dedup import near_duplicates
from dialmesh.llm.packing import pack, token_pieces
from dialmesh.llm.secret_scan import find, redact
from dialmesh.llm.substring_dedup import cut_repeats
from dialmesh.llm.tokenizers_files import public_path
from dialmesh.llm.toxicity import score_toxicity, toxic_by_language
from dialmesh.session import materialize, releasing, scratch_dir


def _with_length(docs: DataFrame) -> DataFrame:
    """Texts may have changed: ``n_chars`` follows, if there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.coalesce(length, "n_chars"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose score reaches the threshold of their language."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    scored = score_toxicity(docs, model, docs.columns, score="__score")
    return scored.where(~toxic_by_language("__score", "lang", model)).drop("__score")


def _content_keys(docs: DataFrame) -> tuple[Column, DataFrame]:
    """A hash of ``doc_id`` and ``text`` that differs between rows which differ in them, and
    ``__row, doc_id, copies`` for each, written.

    A second hash says whether the first is one of two different rows by chance; then other
    hashes are taken.
    """
    for seed in itertools.count():
        key, check = (F.xxhash64(F.lit(2 * seed + i), "doc_id", "text") for i in (0, 1))
        rows = docs.select(key.alias("__row"), check.alias("check"), "doc_id").groupBy("__row").agg(
            F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
            F.min("check").alias("low"), F.max("check").alias("high"),
        )
        rows = materialize(rows)
        if rows.where("low != high").isEmpty():
            return key, rows.select("__row", "doc_id", "copies")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates, the one with the smallest key.

    Each row counts for itself, whether its key is repeated or null; those without words stay.
    Of rows with the same key and text one stays, whatever else they hold.  Most rows are neither
    dropped nor repeated and do not move: a Bloom filter of the others tells.
    """
    path, other = scratch_dir(spark), scratch_dir(spark)
    with releasing():
        key, rows = _content_keys(docs)
        near = near_duplicates(docs.select(key.alias("__row"), "text"), key="__row")
        near = near.groupBy("__row").agg(F.min("component_id").alias("component_id"))
        first = F.min_by(F.struct("__row", "copies"), F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first")
        near = materialize(rows.join(near, "__row").select("__row", "copies", "doc_id", "component_id"))
        kept = materialize(near.groupBy("component_id").agg(first).select("first.*"), path)
        apart = near.join(kept, "__row", "left_anti").select("__row")
        apart = materialize(apart.unionByName(kept.where("copies > 1").select("__row")), other)
    marked = BloomFilter.build(apart, "__row").mark(docs.withColumn("__row", key), F.col("__row"), "__apart")
    sure = marked.where("not __apart").select(docs.columns)
    again = marked.where("__apart").join(kept, "__row", "left_semi").dropDuplicates(["__row"])
    return sure.unionByName(again.select(docs.columns))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that repeat; every document stays."""
    return _with_length(cut_repeats(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets; every document stays."""
    forest = queries.secret_forest(materialize(find(docs, every=True)))
    return _with_length(redact(docs, forest))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096, as ``op10_packing`` returns them."""
    pieces = token_pieces(docs, public_path("word_bpe_49k.json"), 1, queries.CAPACITY)
    return pack(pieces, queries.CAPACITY)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL cannot express the learned stages; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{scratch_dir(spark)}/{name}"
        with releasing():
            docs = materialize(stage(spark, docs, sf_dir), path)
    return docs
