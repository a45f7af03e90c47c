"""Packing token pieces into few sequences of a fixed capacity.

The linear grouping scheme, shard by shard: lengths above an eighth of the capacity
count as large; in order of size they form groups of equal cardinality and are rounded
up to the largest of their group.  A linear program over configurations of these few sizes
(columns made as needed by a knapsack) says how often each configuration is used; the whole
part of it is laid out, actual documents take the rounded places, and what is left, then
the small documents, go best-fit into the gaps.  A few numbers of groups are tried.

Shards hold a bounded number of pieces, dealt out by the place a piece had in its task, so
no key can be hot.  Each costs at most about one sequence more than a single packing would.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_batches
from .tokenizers_files import json_cache

SHARD_PIECES = 8192
SLICE_BYTES = 2_000_000  # text handled at a time
GROUPS = (12, 16, 48)  # numbers of groups tried: few round more, many leave more behind
LARGE_SHARE = 8  # large: over capacity / LARGE_SHARE


def token_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, place`` of each piece of each document.

    A document is the ids of the tokenizers file ``path`` and ``end_id``; only longer ones
    than ``capacity`` are cut, into pieces of that length and a last, shorter one.  Null and
    empty texts hold the end id alone.  ``place`` numbers the pieces of a task.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make():
        cache = json_cache(path)
        place = TaskContext.get().partitionId() << 32

        def step(batch):
            nonlocal place
            keys, texts = batch.columns
            at = 0
            for ids, sizes in cache.encode(texts, SLICE_BYTES):
                slice_keys = keys.slice(at, len(sizes))
                at += len(sizes)
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
                sizes = sizes + 1
                counts = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), counts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                first = (np.cumsum(sizes) - sizes)[doc] + start
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())]
                yield [
                    slice_keys.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(place + np.arange(len(doc)), pa.int64()),
                ]
                place += len(doc)

        return step

    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, place bigint"
    return map_batches(docs.select(key, text), make, schema)


def pack(pieces: DataFrame, capacity: int, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Replace ``place`` by ``sequence_id, offset``; lengths must lie in 1 to ``capacity``.

    Sequences have no gaps from 0.  Equal lengths are taken in the order of ``place``.  No
    pieces give no sequences.
    """
    pieces = materialize(pieces)  # the shard of a piece must not change when a task is run again
    shards = max(1, -(-pieces.count() // shard_pieces))
    kept = [c for c in pieces.columns if c != "place"]
    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in kept)

    def pack_shard(key, shard):
        shard = shard.sort_values("place", kind="stable")
        sequence, offset = pack_lengths(shard["length"].to_numpy(), capacity)
        out = shard[kept].copy()
        out["sequence_id"] = (int(key[0]) << 32) + sequence
        out["offset"] = offset
        return out

    shard = F.pmod(F.xxhash64("place"), F.lit(shards)).alias("__shard")
    return (
        pieces.select("*", shard)
        .groupBy("__shard")
        .applyInPandas(pack_shard, schema + ", sequence_id bigint, offset bigint")
    )


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length: the best packing of those with ``GROUPS`` groups."""
    best, least = None, -(-int(lengths.sum()) // capacity)
    for groups in GROUPS:
        made = _pack(lengths, capacity, groups)
        if best is None or made[0].max(initial=-1) < best[0].max(initial=-1):
            best = made
        if best[0].max(initial=-1) < least:  # no packing has fewer
            break
    return best


def _pack(lengths: np.ndarray, capacity: int, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(lengths)
    sequence, offset = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    bins = _Bins(capacity)
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    full = int(np.searchsorted(-sizes, -capacity, "right"))
    for i in order[:full]:
        sequence[i] = bins.open(capacity)
    large = int(np.searchsorted(-sizes, -(capacity // LARGE_SHARE), "left"))
    left: list[int] = []
    if large > full:
        groups = np.array_split(order[full:large], min(n_groups, large - full))
        queues = [g.tolist() for g in groups]  # each begins with its largest
        rounded = np.array([lengths[g[0]] for g in groups])
        patterns, times = configurations(rounded, np.array([len(g) for g in groups]), capacity)
        for pattern, k in zip(patterns, times):
            for _ in range(k):
                items = [queues[g].pop() for g in np.repeat(np.arange(len(groups)), pattern)]
                at = bins.open(0)
                for i in items:
                    sequence[i], offset[i] = at, bins.add(at, int(lengths[i]))
        left = sorted((i for q in queues for i in q), key=lambda i: (-lengths[i], i))
    bins.index()
    for i in [*left, *order[large:].tolist()]:
        at = bins.best(int(lengths[i]))
        sequence[i], offset[i] = at, bins.put(at, int(lengths[i]))
    return sequence, offset


class _Bins:
    """Sequences by the room they have left."""

    def __init__(self, capacity: int):
        self._capacity = capacity
        self._used: list[int] = []
        self._by_room: dict[int, list[int]] = {}
        self._rooms = 0  # bit r: a sequence has r left

    def open(self, used: int) -> int:
        self._used.append(used)
        return len(self._used) - 1

    def add(self, at: int, length: int) -> int:
        offset = self._used[at]
        self._used[at] += length
        return offset

    def index(self) -> None:
        for at in range(len(self._used)):
            self._file(at)

    def _file(self, at: int) -> None:
        room = self._capacity - self._used[at]
        if room:
            self._by_room.setdefault(room, []).append(at)
            self._rooms |= 1 << room

    def best(self, length: int) -> int:
        """Take out the sequence with the least room that is enough, or open one."""
        fitting = self._rooms >> length
        if not fitting:
            return self.open(0)
        room = length + (fitting & -fitting).bit_length() - 1
        at = self._by_room[room].pop()
        if not self._by_room[room]:
            self._rooms ^= 1 << room
        return at

    def put(self, at: int, length: int) -> int:
        offset = self.add(at, length)
        self._file(at)
        return offset


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list, list[int]]:
    """Patterns (how many of each size fit together) and how often to use each.

    Solves the linear program "least number of patterns that hold ``counts`` of ``sizes``"
    by columns made as needed, and rounds its solution down; what the whole numbers leave
    out is for the caller.
    """
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)  # one column per pattern
    for _ in range(40 * k):
        duals = np.linalg.solve(basis.T, np.ones(k))
        value, column = _knapsack(sizes, duals, capacity)
        if value <= 1 + 1e-7:
            break
        use, change = np.linalg.solve(basis, counts), np.linalg.solve(basis, column)
        steps = np.where(change > 1e-9, np.maximum(use, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(np.argmin(steps))] = column
    use = np.linalg.solve(basis, counts)
    times, left = [], counts.copy()
    patterns = [p for p in basis.T.round().astype(int)]
    for pattern, u in zip(patterns, use):
        fits = int(min(left[pattern > 0] // pattern[pattern > 0])) if pattern.any() else 0
        times.append(max(0, min(int(u + 1e-6), fits)))
        left -= times[-1] * pattern
    return patterns, times


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest worth, any number of each size."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for i, (size, w) in enumerate(zip(sizes.tolist(), worth.tolist())):
        if w <= 0:
            continue
        for begin in range(size, capacity + 1, size):  # stretches that do not read themselves
            end = min(begin + size, capacity + 1)
            other = best[begin - size : end - size] + w
            better = other > best[begin:end] + 1e-12
            best[begin:end][better] = other[better]
            last[begin:end][better] = i
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if last[room] < 0:
            break
        pattern[last[room]] += 1
        room -= int(sizes[last[room]])
    return float(worth @ pattern), pattern
