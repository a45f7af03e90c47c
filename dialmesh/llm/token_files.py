"""Token files: frequency-ranked ids in byte-aligned variable-length code.

A file set is a folder of Parquet files without compression, used as the container of
binary streams, so that Spark commits them and any Hadoop file system holds them.  One row
is one segment of documents in ascending ``doc_id`` order:

``part, segment``  place: parts are ranges of ``doc_id``, segments follow within a part
``before``         ids of the part ahead of this segment
``n_ids``          ids of the segment
``doc_ids``        signed 64-bit little-endian, one per document, and ``doc_null`` one byte each
``doc_sizes``      unsigned 32-bit, ids per document
``ranking``        unsigned 32-bit: the segment's distinct ids, most frequent first
``control``        two bits per id, four ids a byte, low bits first: bytes of its rank less one
``data``           the ranks, low byte first, as many bytes as ``control`` says

The most frequent 256 ids of a segment take one byte each.  Decoding takes the four sizes
of each control byte from a table and then reads each byte plane at once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches
from .tokenizers_files import json_cache

#: Sizes of the four ids of each control byte.
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1

WIDEST = 1 << 22  # ids below this are counted in a table

SEGMENT = (
    "part int, segment int, before bigint, n_ids bigint, doc_ids binary, doc_null binary, "
    "doc_sizes binary, ranking binary, control binary, data binary"
)


def encode_ranks(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """``ranking, control, data`` of a segment's ids (unsigned 32-bit)."""
    names = None
    if ids.max(initial=0) >= WIDEST:  # no places in a vocabulary: number them first
        names, ids = np.unique(ids, return_inverse=True)
    counts = np.bincount(ids)
    distinct = np.flatnonzero(counts)
    ranked = distinct[np.argsort(-counts[distinct], kind="stable")]  # ties: the smaller id first
    rank = np.empty(len(counts), "<u4")
    rank[ranked] = np.arange(len(ranked))
    ranks = rank[ids]
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = codes
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    planes = ranks.view(np.uint8).reshape(-1, 4)
    data = planes[np.arange(4, dtype=np.uint8) <= codes[:, None]]
    ranked = ranked if names is None else names[ranked]
    return ranked.astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def decode_ranks(n_ids: int, ranking: bytes, control: bytes, data: bytes) -> np.ndarray:
    sizes = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n_ids]
    start = np.cumsum(sizes, dtype=np.int64) - sizes
    stream = np.frombuffer(data, np.uint8)
    ranks = stream[start].astype(np.uint32)
    for plane in range(1, int(sizes.max(initial=1))):
        longer = np.flatnonzero(sizes > plane)
        ranks[longer] |= stream[start[longer] + plane].astype(np.uint32) << np.uint32(8 * plane)
    return np.frombuffer(ranking, "<u4")[ranks]


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Tokenize with the tokenizers file ``path`` and write ``folder``.

    Documents are dealt out by ranges of ``key`` (an integer), so that their order in the
    files is that of the key; nulls come first, equal keys in the order of their texts.
    Null and empty texts hold the end id alone.  Writing again replaces the folder.
    """

    def make():
        cache = json_cache(path)
        part = TaskContext.get().partitionId()
        state = {"segment": 0, "before": 0}

        def step(batch):
            keys, texts = batch.columns
            at = 0
            for ids, sizes in cache.encode(texts):
                slice_keys = keys.slice(at, len(sizes))
                at += len(sizes)
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                sizes = sizes + 1
                ranking, control, data = encode_ranks(ids)
                yield [
                    pa.array([v], t) for v, t in (
                        (part, pa.int32()), (state["segment"], pa.int32()), (state["before"], pa.int64()),
                        (len(ids), pa.int64()),
                        (slice_keys.fill_null(0).to_numpy().astype("<i8").tobytes(), pa.binary()),
                        (slice_keys.is_null().to_numpy(zero_copy_only=False).tobytes(), pa.binary()),
                        (sizes.astype("<u4").tobytes(), pa.binary()),
                        (ranking, pa.binary()), (control, pa.binary()), (data, pa.binary()),
                    )
                ]
                state["segment"] += 1
                state["before"] += len(ids)

        return step

    ordered = (
        docs.select(F.col(key).cast("long"), text).repartitionByRange(key).sortWithinPartitions(key, text)
    )
    map_batches(ordered, make, SEGMENT).write.mode("overwrite").option("compression", "none").parquet(folder)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids`` of each document.

    ``start`` counts the ids of all documents before it.  The only thing put together over
    all files is one total per part, of which there are as many as the writing job had
    tasks.
    """
    segments = spark.read.schema(SEGMENT).parquet(folder)
    parts = segments.groupBy("part").agg(F.max(F.col("before") + F.col("n_ids")).alias("total"))
    total = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    base = parts.select("part", total.alias("base"))
    columns = ["n_ids", "doc_ids", "doc_null", "doc_sizes", "ranking", "control", "data"]
    rows = segments.join(F.broadcast(base), "part").select(
        (F.col("base") + F.col("before")).alias("first"), *columns
    )

    def make():
        def step(batch):
            for row in batch.to_pylist():
                yield _documents(row, with_ids)

        return step

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return map_batches(rows, make, schema + ", ids array<bigint>" * with_ids)


def _documents(row: dict, with_ids: bool) -> list[pa.Array]:
    ids = decode_ranks(row["n_ids"], row["ranking"], row["control"], row["data"])
    sizes = np.frombuffer(row["doc_sizes"], "<u4").astype(np.int64)
    ends = np.cumsum(sizes)
    view = memoryview(ids.astype("<u4").tobytes())
    crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
    missing = np.frombuffer(row["doc_null"], bool)
    columns = [
        pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=missing),
        pa.array(row["first"] + ends - sizes, pa.int64()),
        pa.array(sizes, pa.int64()),
        pa.array(crc, pa.int64()),
    ]
    if with_ids:
        offsets = pa.array(np.r_[0, ends].astype(np.int32))
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
    return columns
