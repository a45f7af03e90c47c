"""Joins that stay even when one key holds a large part of a side, and Bloom filters.

Adaptive execution splits a skewed partition only when both sides of the join come
straight from a shuffle; a bucketed table or an aggregate on one side rules that
out.  So hot keys are found and split off here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .session import materialize

HOT_ROWS = 1_000_000  # rows of one key that a single task can take without trouble
BLOCK_WORDS = 64  # 64-bit words in a block of a Bloom filter
KEY_BITS = 16  # bits of the filter per key, up to MAX_BLOCKS
MAX_BLOCKS = 1 << 18  # 128 MB, which is full size for 67 million keys
PROBES = 5  # bits set for a key, all in one block: 12 bits of a hash each
HOT_SHARE = 4  # above that, hot is more than 1 / (HOT_SHARE * shuffle partitions)


def lookup_join(
    many: DataFrame, one: DataFrame, key: str, how: str = "inner", rows: int | None = None
) -> DataFrame:
    """Join ``many`` with ``one``, which has few rows per key.

    The rows of hot keys stay where they are and meet a broadcast of their few
    partners; all other rows are joined by shuffle.  There are at most
    ``rows / HOT_ROWS`` hot keys, and never more than ``HOT_SHARE`` per shuffle
    partition, which bounds the broadcast.  ``rows`` is the size of ``many`` where
    it is known; otherwise its keys are counted.
    """
    rows = many.count() if rows is None else rows
    partitions = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(HOT_ROWS, rows // (HOT_SHARE * partitions))
    if rows <= limit:
        return many.join(one, key, how)
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(counts.where(F.col("_n") > limit).select(key))
    if hot.isEmpty():
        return many.join(one, key, how)
    hot = F.broadcast(hot)
    partners = F.broadcast(one.join(hot, key, "left_semi"))
    spread = many.join(hot, key, "left_semi").join(partners, key, how)
    rest = many.join(hot, key, "left_anti").join(one, key, how)
    return spread.unionByName(rest)


@dataclass(frozen=True)
class BloomFilter:
    """A set of keys in ``blocks(block, words)``, of bounded size whatever their number.

    A key that is in the set always passes.  Of other keys less than one in a hundred passes
    up to 67 million keys in the set, and more beyond; a join after it drops them.
    """

    blocks: DataFrame
    n_blocks: int

    @staticmethod
    def build(keys: DataFrame, key: str) -> BloomFilter:
        n_keys = keys.where(F.col(key).isNotNull()).count()
        n_blocks = min(MAX_BLOCKS, max(1, -(-n_keys * KEY_BITS // (64 * BLOCK_WORDS))))
        block, places = _bloom_places(F.col(key), n_blocks)
        bits = keys.where(F.col(key).isNotNull()).select(block.alias("block"), F.explode(F.array(*places)).alias("place"))
        one = F.expr("shiftleft(bigint(1), int(place % 64))")
        words = bits.groupBy("block", F.expr("int(place div 64)").alias("word")).agg(F.bit_or(one).alias("bits"))
        listed = F.map_from_entries(F.collect_list(F.struct("word", "bits")))  # at most BLOCK_WORDS
        filled = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("bigint")))
        blocks = words.groupBy("block").agg(listed.alias("m")).select("block", filled.alias("words"))
        return BloomFilter(materialize(blocks), n_blocks)

    def keep(self, rows: DataFrame, key: Column) -> DataFrame:
        """The rows whose key may be in the set; those without a key go."""
        block, set_all = self._probe(key)
        probed = rows.withColumn("_block", block).join(self._words(), "_block")
        return probed.where(set_all).select(*rows.columns)

    def mark(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """All rows, with whether their key may be in the set; false without a key."""
        block, set_all = self._probe(key)
        probed = rows.withColumn("_block", block).join(self._words(), "_block", "left")
        return probed.select(*rows.columns, F.coalesce(set_all, F.lit(False)).alias(name))

    def _words(self) -> DataFrame:
        return F.broadcast(self.blocks.select(F.col("block").alias("_block"), F.col("words").alias("_words")))

    def _probe(self, key: Column) -> tuple[Column, Column]:
        """The block of a key, and whether all its bits are set in ``_words``."""
        block, places = _bloom_places(key, self.n_blocks)
        set_all = F.lit(True)
        for place in places:
            word = F.get("_words", F.shiftright(place, 6).cast("int"))
            set_all = set_all & (F.bit_get(word, (place % 64).cast("int")) == 1)
        return F.when(key.isNotNull(), block), set_all


def _bloom_places(key: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    block = F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")
    bits = F.xxhash64(key, F.lit(1))
    return block, [F.shiftrightunsigned(bits, 12 * i).bitwiseAND(64 * BLOCK_WORDS - 1) for i in range(PROBES)]
