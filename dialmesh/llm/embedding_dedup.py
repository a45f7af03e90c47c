"""Near-duplicate vectors by cosine, through int8 tile products with error bounds.

1. Equal vectors are one class with one representative and a number of copies.
2. A unit vector u is kept as scale * q with q in int8 and the norm e of what that leaves out,
   so for two vectors ``|cos - scale_u scale_v (q_u . q_v)| <= e_u + e_v + e_u e_v``.
3. Classes are dealt by their fingerprint into as many blocks as their number needs, however
   the input is partitioned.  Tiles (pairs of blocks) take the integer products, exact in
   single precision.  The bound settles most pairs; vectors of the others are open.
4. Open vectors alone come back to their tile with their components, and the pairs that the
   bound left undecided are computed in double precision.

A tile gives, per vector, the number of its links and one link to the root of its component
within the tile, never the pairs.  The tiles cover all pairs of blocks: random directions
leave no block out, so the work is the square of the classes, spread evenly, and each int8
vector is sent once per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_batches
from .components import connected_components

BLOCK_ROWS = 16384
STRIP = (512, 8192)  # rows and columns of a tile looked at together
EXACT_DIM = 1 << 10  # sums of so many products of int8 are whole numbers in single precision
ROUNDING = 1e-6  # of scaled products in single precision
SLACK = 1e-12  # of sums in double precision
ROWS = "row bigint, id bigint, print bigint, print2 bigint, dim int, vector binary"
CLASSES = "row bigint, copies bigint, dim int, block bigint, q binary, scale double, error double"
FOUND = "i bigint, j bigint, row bigint, n bigint, root bigint, open boolean"


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales and error norms of the unit vectors; zero vectors stay zero."""
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
    scale = np.abs(unit).max(axis=1, initial=0) / 127
    safe = np.where(scale > 0, scale, 1)[:, None]
    q = np.rint(unit / safe).astype(np.int8)
    error = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q, scale, error


def embedding_duplicates(
    rows: DataFrame,
    threshold: float = 0.9,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``key, n_links, component_id, kept`` of each row.

    Rows link when their cosine, in double precision, is at least ``threshold`` (over 0).
    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths.  ``component_id`` is the smallest key
    reachable by links, the row's own included; ``kept`` marks the row with that key.  Rows
    with the same key are different vectors of one node.  A row without a key is a link of
    others and leads on to theirs, and has the key of its component, if any, but is not kept.
    """
    plain = materialize(_rows(rows, key, vector))
    usable = plain.where("dim > 0")
    classes = materialize(usable.groupBy("print", "print2", "dim").agg(
        F.min("row").alias("class"), F.min("id").alias("one"), F.count(F.lit(1)).alias("copies")
    ))
    small = materialize(quantised(plain, classes, block_rows))
    found = materialize(_tiles(small, threshold))
    late = materialize(_open_pairs(found.where("open"), small, plain, threshold))
    found = found.where("n > 0").unionByName(late)

    named = classes.select("print", "print2", "dim", "class")
    placed = materialize(
        plain.drop("vector").join(named, ["print", "print2", "dim"], "left").select("id", "class")
    )
    links = found.select(F.col("row").alias("a"), F.col("root").alias("b")).unionByName(_same_key(placed))
    part = materialize(connected_components(links).withColumnRenamed("node", "class"))
    ones = classes.select("class", "one").join(part, "class")
    ones = ones.groupBy("component").agg(F.min("one").alias("smallest"))
    counts = found.groupBy("row").agg(F.sum("n").alias("n")).withColumnRenamed("row", "class")
    about = (
        classes.select("class", "one", (F.col("copies") - 1).alias("equal"))
        .join(counts, "class", "left")
        .join(part.join(ones, "component"), "class", "left")
        .select(
            "class",
            (F.col("equal") + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("smallest", "one").alias("smallest"),
        )
    )
    kind = rows.schema[key].dataType
    usable = placed.where("class is not null").join(about, "class").select("id", "n_links", "smallest")
    # a key's unusable vectors go with its usable ones
    by_key = placed.where("id is not null").groupBy("id").agg(F.max("class").alias("class"))
    by_key = by_key.join(about, "class").select("id", F.lit(0).cast("long").alias("n_links"), "smallest")
    idle = placed.where("class is null").select("id").join(by_key, "id", "left")
    component = F.coalesce("smallest", "id")
    return usable.unionByName(idle).select(
        F.col("id").cast(kind).alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _rows(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows numbered, their vectors as bytes under a fingerprint; ``dim`` is 0 where unusable."""
    stored = "<f4" if rows.schema[vector].dataType.simpleString() == "array<float>" else "<f8"

    def make():
        place = TaskContext.get().partitionId() << 36

        def step(batch):
            nonlocal place
            ids, lists = batch.columns
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(lists.offsets.to_numpy()))
            for dim in np.unique(sizes).tolist():
                chosen = pa.array(np.flatnonzero(sizes == dim))
                values = _finite(lists.take(chosen), dim).astype(stored)
                listed = [v.tobytes() for v in values]
                prints = np.array([np.frombuffer(xxhash.xxh3_128_digest(v), np.int64) for v in listed])
                yield [
                    pa.array(place + np.arange(len(chosen)), pa.int64()), ids.take(chosen),
                    pa.array(prints[:, 0], pa.int64()), pa.array(prints[:, 1], pa.int64()),
                    pa.array(np.where(values.any(1), dim, 0), pa.int32()), pa.array(listed, pa.binary()),
                ]
                place += len(chosen)

        return step

    return map_batches(rows.select(F.col(key).cast("long"), F.col(vector).cast("array<double>")), make, ROWS)


def _finite(lists: pa.Array, dim: int) -> np.ndarray:
    """The vectors, zero where a component is not a finite number, within the range of squares."""
    if not dim:
        return np.zeros((len(lists), 0))
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)  # null reads as nan
    values = np.where(np.isfinite(values).all(1, keepdims=True), values, 0) + 0.0  # one zero only
    largest = np.abs(values).max(axis=1, keepdims=True)
    tame = np.divide(values, largest, out=np.zeros_like(values), where=largest > 0) + 0.0
    extreme = (largest > 1e150) | ((largest < 1e-150) & (largest > 0))
    return np.where(extreme, tame, values)


def _matrix(binary: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Binary values of one length, as rows of ``dim`` numbers."""
    joined = b"".join(binary.to_pylist())
    kinds = {1: np.int8, 4: "<f4", 8: "<f8"}
    return np.frombuffer(joined, kinds[len(joined) // (len(binary) * dim)]).reshape(-1, dim)


def quantised(plain: DataFrame, classes: DataFrame, block_rows: int) -> DataFrame:
    """The classes in int8, each with its block of about ``block_rows``."""
    n_blocks = max(1, -(-classes.count() // block_rows))
    block = F.pmod("print", F.lit(n_blocks)).alias("block")
    chosen = classes.select(F.col("class").alias("row"), "copies", block).join(
        plain.select("row", "dim", "vector"), "row"
    )

    def make():
        def step(batch):
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                q, scale, error = quantise(_matrix(part.column("vector"), dim).astype(float))
                yield [
                    part.column("row"), part.column("copies"), part.column("dim"), part.column("block"),
                    pa.array([v.tobytes() for v in q], pa.binary()), pa.array(scale), pa.array(error),
                ]

        return step

    return map_batches(chosen, make, CLASSES)


def _tiles(small: DataFrame, threshold: float) -> DataFrame:
    """Links that the bounds make certain, and the vectors with undecided pairs, by tile."""
    last = small.agg(F.max("block")).first()[0] or 0
    ends = small.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("other"))
    ends = ends.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), *small.columns)
    return ends.groupBy("i", "j").applyInArrow(lambda tile: _link(tile, threshold), FOUND)


def _open_pairs(opened: DataFrame, small: DataFrame, plain: DataFrame, threshold: float) -> DataFrame:
    """Links among the undecided pairs, by their full vectors."""
    full = opened.select("i", "j", "row").join(small, "row").join(plain.select("row", "vector"), "row")
    return full.groupBy("i", "j").applyInArrow(lambda tile: _link(tile, threshold), FOUND)


def _same_key(placed: DataFrame) -> DataFrame:
    """Links ``a, b`` between the classes that share a key."""
    keyed = placed.where("id is not null and class is not null")
    several = keyed.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("last")).where("a < last")
    return keyed.join(several, "id").select("a", F.col("class").alias("b")).distinct()


def _link(tile: pa.Table, threshold: float) -> pa.Table:
    """The links of a tile: certain ones, or undecided ones if it has the full vectors."""
    out = [_link_length(tile.filter(pc.equal(tile.column("dim"), d)), d, threshold)
           for d in sorted(set(tile.column("dim").to_pylist()))]
    return pa.concat_tables(out)


def _link_length(tile: pa.Table, dim: int, threshold: float) -> pa.Table:
    tile = tile.sort_by("row")
    i, j = tile.column("i")[0].as_py(), tile.column("j")[0].as_py()
    rows, copies = tile.column("row").to_numpy(), tile.column("copies").to_numpy()
    q, scale = _matrix(tile.column("q"), dim), tile.column("scale").to_numpy()
    error = tile.column("error").to_numpy()
    full = _matrix(tile.column("vector"), dim) if "vector" in tile.column_names else None
    block = tile.column("block").to_numpy()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    count, opened, parent = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool), np.arange(len(rows))
    for r0 in range(0, len(left), STRIP[0]):
        a = left[r0 : r0 + STRIP[0]]
        for c0 in range(0, len(right), STRIP[1]):
            b = right[c0 : c0 + STRIP[1]]
            if i == j and b[-1] <= a[0]:
                continue
            for r, c, near in _reaching(q, scale, error, a, b, threshold):
                if i == j:
                    later = c > r
                    r, c, near = r[later], c[later], near[later]
                bound = error[r] + error[c] + error[r] * error[c] + SLACK
                sure = near - bound >= threshold
                open_ = ~sure & (near + bound >= threshold)
                if full is None:
                    opened[r[open_]] = opened[c[open_]] = True
                    linked = sure
                else:
                    linked = np.zeros(len(r), bool)
                    linked[open_] = _cosine(full[r[open_]], full[c[open_]]) >= threshold
                r, c = r[linked], c[linked]
                np.add.at(count, r, copies[c])
                np.add.at(count, c, copies[r])
                _join_rows(parent, r, c)
    chosen = np.flatnonzero((count > 0) | opened)
    columns = [
        pa.array(np.full(len(chosen), i), pa.int64()), pa.array(np.full(len(chosen), j), pa.int64()),
        pa.array(rows[chosen]), pa.array(count[chosen]), pa.array(rows[_roots(parent, chosen)]),
        pa.array(opened[chosen]),
    ]
    return pa.table(columns, names=["i", "j", "row", "n", "root", "open"])


def _reaching(q, scale, error, a, b, threshold):
    """Parts of the pairs of ``a`` and ``b`` that may reach the threshold, with their scaled
    integer product, which is the same number in whatever strip the pair lies."""
    dim = q.shape[1]
    product = np.zeros((len(a), len(b)), np.float32 if dim <= EXACT_DIM else np.float64)
    for k in range(0, dim, EXACT_DIM):
        product += q[a, k : k + EXACT_DIM].astype(np.float32) @ q[b, k : k + EXACT_DIM].astype(np.float32).T
    loosest = error[a] + (1 + error[a]) * error[b].max() + ROUNDING
    least = ((threshold - loosest) / np.where(scale[a] > 0, scale[a], 1)).astype(np.float32)
    r, c = np.nonzero(product * scale[b].astype(np.float32) >= least[:, None])
    for at in range(0, len(r), 100_000):
        rr, cc = r[at : at + 100_000], c[at : at + 100_000]
        yield a[rr], b[cc], product[rr, cc].astype(float) * scale[a[rr]] * scale[b[cc]]


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(float), b.astype(float)
    norms = np.sqrt((a * a).sum(1) * (b * b).sum(1))
    return np.divide((a * b).sum(1), norms, out=np.zeros(len(a)), where=norms > 0)


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    while True:
        up = parent[nodes]
        if (up == nodes).all():
            return up
        nodes = up


def _join_rows(parent: np.ndarray, r: np.ndarray, c: np.ndarray) -> None:
    """Put the ends of pairs together; pairs come in the order of ``r``."""
    cuts = np.flatnonzero(np.diff(r)) + 1
    for row, linked in zip(r[np.r_[0, cuts]] if len(r) else (), np.split(c, cuts)):
        roots = _roots(parent, np.append(linked, row))
        parent[roots] = parent[linked] = parent[row] = roots.min()
