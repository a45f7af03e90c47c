"""Near-duplicate documents by MinHash in an LSH forest, confirmed on full shingle sets.

Every document has one signature of ``VALUES`` minima.  Tree t of the forest sorts the
documents by the signature read from value ``3 t`` on, so documents with a long common prefix
are neighbours in it.  A region is the set of documents that share a prefix, a stretch of
that order; its depth adapts: it starts at three values and grows where a region holds more
than ``REGION`` documents, until no region does or the signatures end.

1. Documents with equal sets are one class with one representative.
2. Each region is sorted by the values that follow its prefix.  Of all orders each document
   takes the neighbour with which it has the longest common prefix as a candidate.  In each
   region every member is also paired with one leader: the smallest, or, in a crowded
   region on the way, the member that stands in the largest regions and so is closest to
   all.  These pairs are confirmed on full sets and linked documents put together.
3. In regions that still hold several components, documents that signatures and sizes let
   link with another component meet again with their full sets, in the task of the region,
   which gives only the links that join components.
4. In regions of the least depth that were crowded, members outside the largest component
   (by then few) meet all members in the same way, in pairs of blocks.

So within a region of the least depth no link is missed, and no pairs leave a task but one
per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..joins import BloomFilter, lookup_join
from ..session import BucketedTable, materialize
from .common import map_batches, slices
from .components import connected_components
from .word_hashes import split_words, window_hashes

SHINGLE = 5
VALUES = 64
TREES = 21  # three values each at the least depth
LEAST_DEPTH = 3
STEPS = ((LEAST_DEPTH,), (5, 8), (12, 18, 27, 40, VALUES))  # depths, those of a step counted together
REGION = 256
SORTED = 8  # values after the prefix of a region by which it is sorted
PERCENT = 75
#: Equal values of two signatures below which a pair is not tried; at a similarity of 0.75
#: fewer than one pair in 30,000 has so few.
LEAST_EQUAL = 34

_RANDOM = np.random.default_rng(20)
_FLIP = _RANDOM.integers(0, 2**64, VALUES, dtype=np.uint64)
_FACTOR = _RANDOM.integers(0, 2**64, VALUES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text.

    Words are lower-cased in A-Z; a text of fewer than five words has its whole sequence as
    one shingle, one without words none.
    """
    words = split_words(texts, lower=True)
    hashes = words.hashes()
    grams = window_hashes(hashes, SHINGLE)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= SHINGLE:
            sets.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            sets.append(np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes())], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``VALUES`` minima (unsigned 32-bit) of each set, which must not be empty."""
    sizes = np.array([len(s) for s in sets])
    flat, first = np.concatenate(sets), np.cumsum(sizes) - sizes
    out = np.empty((len(sets), VALUES), np.uint32)
    for k in range(VALUES):
        values = ((flat ^ _FLIP[k]) * _FACTOR[k] >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(values, first)
    return out


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, region: int = REGION, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of each row.

    Documents link when ``100 * intersection >= percent * union`` of their shingle sets;
    those without words link with nothing.  ``component_id`` is the smallest key reachable by
    links, the row's own included.  Rows with the same key count as one document, which has
    the links of any of them; a row without a key has no component and is kept.
    """
    kind = docs.schema[key].dataType
    texts = docs.select(F.coalesce(text, F.lit("")).alias("text"), F.col(key).cast("long").alias("id"))
    signed = materialize(map_batches(
        texts, _sign, "id bigint, n bigint, print bigint, print2 bigint, signature binary"
    ))
    alike = signed.where("n > 0 and id is not null").groupBy("print", "print2", "n", "signature")
    classes = materialize(alike.agg(F.min("id").alias("one")))
    regions, leaders, crowd = _regions(classes.select("one", "signature"), region)
    star = regions.select("leader", "one").unionByName(leaders).unionByName(_nearest(regions)).where("one != leader")
    star = materialize(star.select(F.least("leader", "one").alias("a"), F.greatest("leader", "one").alias("b")).distinct())
    ends = star.select(F.col("a").alias("one")).unionByName(star.select(F.col("b").alias("one")))
    # all members of regions are ends of star pairs
    ends = ends.distinct().join(classes.select("one", "print", "print2"), "one")
    sets = _sets(texts, ends)
    links = materialize(_confirmed(star, sets, percent))
    # a pair of a crowded region on the way is compared below it, or else by blocks
    more = materialize(_across(regions, _together(links), classes, sets, percent, crowd))
    part = materialize(connected_components(links.unionByName(more)))
    if crowd is not None:
        late = materialize(_across(_blocks(crowd, part, 4 * region), part, classes, sets, percent))
        if not late.isEmpty():
            stars = part.select(F.col("component").alias("a"), F.col("node").alias("b"))
            part = materialize(connected_components(stars.unionByName(late)))
    sets.drop()
    part = part.withColumnRenamed("node", "one")
    result = (
        signed.select("id", "n", "print", "print2")
        .join(classes.select("print", "print2", "n", "one"), ["print", "print2", "n"], "left")
        .join(part, "one", "left")
        .select("id", "n", F.coalesce("component", "one", "id").alias("component"))
    )
    return result.select(
        F.col("id").cast(kind).alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.col("component")).cast(kind).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"),
    )


def _together(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest document that a link of it leads to.

    Equal marks are linked for certain; different ones may be too, by longer ways, which
    costs the next step some comparisons and no link.
    """
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    least = ends.groupBy("node").agg(F.min("other").alias("other"))
    return materialize(least.select("node", F.least("node", "other").alias("component")))


def _print(shingles: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


def _sign():
    def step(batch):
        for texts, ids in slices(*batch.columns):
            sets = shingle_sets(texts)
            filled = [i for i, s in enumerate(sets) if len(s)]
            made = signatures([sets[i] for i in filled]) if filled else ()
            signature: list = [None] * len(sets)
            for i, row in zip(filled, made):
                signature[i] = row.tobytes()
            prints = [_print(s) for s in sets]
            yield [
                ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                pa.array([p[1] for p in prints], pa.int64()), pa.array(signature, pa.binary()),
            ]

    return step


def _keys(depths: tuple[int, ...], all_trees: bool):
    """``tree, depth, region, parent, one, rest`` for the prefixes of each of ``depths`` values.

    ``parent`` is the region of the next lesser of ``depths``; ``rest`` holds the next
    ``SORTED`` values, so that its order is that of the signatures.
    """

    def step(batch):
        ones, rows = batch.column(0), np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)
        rows = rows.reshape(-1, VALUES).astype(np.uint64)
        trees = None if all_trees else batch.column(2)
        for tree in range(TREES):
            chosen = np.arange(len(rows))
            if trees is not None:
                in_tree = [tree in t for t in trees.to_pylist()]
                chosen = np.flatnonzero(in_tree)
            parent = pa.nulls(len(chosen), pa.int64())
            for depth in depths:
                order = (3 * tree + np.arange(depth)) % VALUES
                names = np.full(len(chosen), np.uint64(tree * 1000 + depth))
                for values in rows[chosen][:, order].T:
                    names = names * np.uint64(0xD6E8FEB86659FD93) + values
                    names ^= names >> np.uint64(29)
                after = (3 * tree + np.arange(depth, min(depth + SORTED, VALUES))) % VALUES
                rest = rows[chosen][:, after].astype(">u4")
                ends = np.arange(len(chosen) + 1, dtype=np.int32) * rest.shape[1] * 4
                region = pa.array(names.view(np.int64), pa.int64())
                yield [
                    pa.array(np.full(len(chosen), tree), pa.int32()), pa.array(np.full(len(chosen), depth), pa.int32()),
                    region, parent, ones.take(pa.array(chosen)),
                    pa.Array.from_buffers(pa.binary(), len(chosen), [None, pa.py_buffer(ends), pa.py_buffer(rest.tobytes())]),
                ]
                parent = region

    return step


def _regions(classes: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``tree, region, one, leader, depth, rest`` for all final regions of two members or more,
    ``leader, one`` for the members of the crowded regions on the way, and ``tree, region,
    one`` of the crowded regions of the least depth, if there are any.

    A region is final if its parent is crowded and it is not; the first depth of a step has
    only members of crowded parents.
    """
    found, widest, leaders, active = None, None, classes.selectExpr("one", "one AS leader").where("false"), classes
    for depths in STEPS:
        first, last = depths == STEPS[0], depths == STEPS[-1]
        kind = "tree int, depth int, region bigint, parent bigint, one bigint, rest binary"
        rows = map_batches(active, lambda d=depths, f=first: _keys(d, f), kind)
        repeated = materialize(rows.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("region"))
        # most regions hold one document, and their rows need not move any further
        rows = materialize(BloomFilter.build(repeated, "region").keep(rows, F.col("region")))
        sizes = rows.groupBy("region").agg(
            F.count(F.lit(1)).alias("n"), F.min("one").alias("leader"), F.min("depth").alias("depth"), F.min("parent").alias("parent")
        )
        sizes = materialize(sizes.where("n > 1"))
        crowded = sizes.where((F.col("n") > limit) & (F.col("depth") < VALUES)).select("region", "n")
        final = sizes.where((F.col("n") <= limit) | (F.col("depth") == VALUES))
        if len(depths) > 1:
            inner = final.where("parent is not null").join(crowded.select(F.col("region").alias("parent")), "parent", "left_semi")
            final = final.where("parent is null").unionByName(inner)
        members = rows.select("tree", "region", "one", "depth", "rest").join(final.select("region", "leader", "n"), "region")
        members = members.select("tree", "region", "one", "leader", "depth", "rest", "n")
        if last:  # equal signatures throughout: parts in the order of a hash
            part = F.pmod(F.xxhash64("one"), F.ceil(F.col("n") / limit))
            members = members.withColumn("region", F.when(F.col("n") > limit, F.xxhash64("region", part)).otherwise(F.col("region")))
        members = members.drop("n")
        found = members if found is None else found.unionByName(members)
        if crowded.isEmpty():
            break
        crowd = materialize(rows.select("tree", "depth", "region", "one").join(crowded, "region"))
        widest = crowd.select("tree", "region", "one") if first else widest
        dense = crowd.withColumn("density", F.sum("n").over(Window.partitionBy("one", "depth")))  # at most TREES rows
        leader = F.max_by("one", F.struct("density", -F.col("one"))).alias("leader")
        leader = materialize(dense.groupBy("region").agg(leader))
        leaders = leaders.unionByName(crowd.select("region", "one").join(leader, "region").select("one", "leader"))
        if not last:
            deeper = crowd.where(F.col("depth") == depths[-1]).groupBy("one").agg(F.collect_list("tree").alias("trees"))
            active = materialize(classes.select("one", "signature").join(deeper, "one"))
    return materialize(found), leaders, widest


def _nearest(regions: DataFrame) -> DataFrame:
    """``leader, one``: of the neighbours of ``one`` in all sorted orders, the one with the
    longest common prefix."""
    order = Window.partitionBy("region").orderBy("rest", "one")
    near = regions.select("one", "depth", "rest", *(
        f(c).over(order).alias(name)
        for f, names in ((F.lag, ("before", "rest_before")), (F.lead, ("after", "rest_after")))
        for c, name in zip(("one", "rest"), names)
    ))
    up, down = _common("rest_before"), _common("rest_after")
    best = F.when(F.col("before").isNull() | (down > up), F.struct(F.col("after").alias("leader"), down.alias("common")))
    near = near.select("one", best.otherwise(F.struct(F.col("before").alias("leader"), up.alias("common"))).alias("best"))
    near = near.select("one", "best.*").where("leader is not null")
    # ties by a hash, so that no document is the choice of all
    rank = F.shiftleft(F.col("common").cast("long"), 56) + F.shiftrightunsigned(F.xxhash64("one", "leader"), 8)
    return near.groupBy("one").agg(F.max_by("leader", rank).alias("leader")).select("leader", "one")


def _common(other: str) -> Column:
    """Length of the common prefix of a signature and its neighbour's; -1 without neighbour."""
    alike = lambda k: F.substring("rest", 1, 4 * k) == F.substring(other, 1, 4 * k)
    more = sum(((F.length("rest") >= 4 * k) & alike(k)).cast("int") for k in range(1, SORTED + 1))
    return F.coalesce(F.col("depth") + more, F.lit(-1))


def _blocks(crowd: DataFrame, part: DataFrame, size: int) -> DataFrame:
    """``region, one, tree``: crowded regions as pairs of blocks of about ``size`` members, one of
    members outside the largest component of the region and one of any.

    Each two members of different components share a pair of blocks.  ``tree`` is that of
    the region.
    """
    placed = crowd.join(part.withColumnRenamed("node", "one"), "one", "left")
    placed = materialize(placed.select("tree", "region", "one", F.coalesce("component", "one").alias("component")))
    counts = placed.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    most = F.max_by("component", F.struct("n", "component"))
    shape = counts.groupBy("region").agg(most.alias("most"), F.sum("n").alias("n"), F.max("n").alias("top"))
    blocks = lambda n: F.ceil(n / size)
    shape = materialize(shape.where("n > top").select(
        "region", "most", blocks(F.col("n")).alias("n_all"), blocks(F.col("n") - F.col("top")).alias("n_open")
    ))
    members = placed.join(shape, "region")
    block = lambda n: F.pmod(F.xxhash64("one"), n)
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    opened = members.where("component != most").select(
        "tree", "region", "one", block(F.col("n_open")).alias("i"), numbers("n_all").alias("j")
    )
    others = members.select("tree", "region", "one", numbers("n_open").alias("i"), block(F.col("n_all")).alias("j"))
    return opened.unionByName(others).select(F.xxhash64("region", "i", "j").alias("region"), "one", "tree").distinct()


def _sets(texts: DataFrame, ends: DataFrame) -> BucketedTable:
    """``one, n, shingles`` of the documents in ``ends``, in buckets of ``one``.

    Sets are made where the texts are, of those that a Bloom filter of ``ends`` lets pass, and
    move once; texts do not move.
    """
    ends = materialize(ends)
    chosen = BloomFilter.build(ends, "one").keep(texts, F.col("id")).select("text", "id")

    def make():
        def step(batch):
            for texts, ids in slices(*batch.columns):
                sets = shingle_sets(texts)
                prints = [_print(s) for s in sets]
                yield [
                    ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                    pa.array([p[1] for p in prints], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
                ]

        return step

    made = map_batches(chosen, make, "one bigint, n bigint, made bigint, made2 bigint, shingles binary")
    # a key may have other texts too; equality would become a key of the join, and sets move twice
    same = "(made ^ print) = 0 and (made2 ^ print2) = 0"
    own = made.join(ends, "one").where(same).select("one", "n", "shingles")
    return BucketedTable(own.dropDuplicates(["one"]), "one")


def _confirmed(pairs: DataFrame, sets: BucketedTable, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link."""
    left = sets.df.select(F.col("one").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("set_a"))
    right = sets.df.select(F.col("one").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("set_b"))
    # a smaller set bounds the intersection, a larger one the union
    rows = pairs.count()  # a leader may stand in very many of them
    both = lookup_join(lookup_join(pairs, left.drop("set_a"), "a", rows=rows), right.drop("set_b"), "b", rows=rows)
    both = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b")
    both = lookup_join(lookup_join(both, left, "a", rows=rows), right, "b", rows=rows).select("a", "b", "set_a", "set_b")

    def make():
        def step(batch):
            linked = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                joint = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * joint >= percent * (len(a) + len(b) - joint))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_())).columns

        return step

    return map_batches(both, make, "a bigint, b bigint")


def _across(
    regions: DataFrame, part: DataFrame, classes: DataFrame, sets: BucketedTable, percent: int, crowd: DataFrame | None = None
) -> DataFrame:
    """Links ``a, b`` that join different components of one region.

    Two documents are compared in one region of the least depth only, the first in the order of
    trees, which has all of its members unless it is in ``crowd``; in deeper regions (which
    have a ``depth``) only if they share none of these.
    """
    placed = regions.join(part.withColumnRenamed("node", "one"), "one", "left")
    tree = F.when(F.col("depth") == LEAST_DEPTH, F.col("tree")).otherwise(-1) if "depth" in regions.columns else F.col("tree")
    placed = placed.select("region", "one", F.coalesce("component", "one").alias("component"), tree.alias("tree"))
    split = placed.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    split = materialize(split.where("low != high").select("region"))
    members = materialize(placed.join(split, "region"))
    # signatures only of members move
    signed = BloomFilter.build(members.select("one").distinct(), "one").keep(classes.select("one", "n", "signature"), F.col("one"))
    if crowd is not None:
        crowded = crowd.groupBy("one").agg(F.sum(F.expr("shiftleft(1L, tree)")).alias("crowded"))  # one region in each tree
        signed = signed.join(crowded, "one", "left")
    else:
        signed = signed.withColumn("crowded", F.lit(None).cast("long"))
    signed = signed.withColumn("crowded", F.coalesce("crowded", F.lit(0).cast("long")))
    members = members.join(signed, "one")

    def involved(region: pa.Table) -> pa.Table:
        possible = np.zeros(len(region), bool)
        for i, partners in _possible(region, percent):
            possible[i] = possible[partners] = True
        return region.filter(pa.array(possible))

    def links(region: pa.Table) -> pa.Table:
        ones, component = region.column("one").to_numpy(), region.column("component").to_numpy().copy()
        shingles = [np.frombuffer(s.as_buffer(), np.uint64) for s in region.column("shingles")]
        found = []
        for i, partners in _possible(region, percent):
            for j in partners.tolist():
                if component[i] == component[j]:
                    continue
                a, b = shingles[i], shingles[j]
                joint = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * joint >= percent * (len(a) + len(b) - joint):
                    found.append((ones[i], ones[j]))
                    component[component == component[j]] = component[i]
        a, b = zip(*found) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    kind = "region bigint, one bigint, component bigint, n bigint, signature binary, tree int, crowded bigint"
    members = members.select("region", "one", "component", "n", "signature", "tree", "crowded")
    open_rows = materialize(members.groupBy("region").applyInArrow(involved, kind))
    with_sets = open_rows.join(sets.df.select("one", "shingles"), "one")
    return with_sets.groupBy("region").applyInArrow(links, "a bigint, b bigint")


def _possible(region: pa.Table, percent: int):
    """Each row with the later ones of other components that it may link with.

    ``tree`` is that in which the region is whole, -1 if in none; pairs that are compared in a whole
    region of another tree are left out.  Bits of ``crowded`` name trees whose region is not whole.
    """
    component, n = region.column("component").to_numpy(), region.column("n").to_numpy()
    rows = np.frombuffer(b"".join(region.column("signature").to_pylist()), np.uint32).reshape(-1, VALUES)
    tree = region.column("tree")[0].as_py() if len(n) else None
    crowded = region.column("crowded").to_numpy() if "crowded" in region.column_names else np.zeros(len(n), np.int64)
    for i in range(len(n) - 1):
        small, large = np.minimum(n[i], n[i + 1 :]), np.maximum(n[i], n[i + 1 :])
        other = component[i + 1 :] != component[i]
        later = i + 1 + np.flatnonzero(other & (100 * small >= percent * large))
        if len(later):  # signatures only of these: most members are of one component
            equal = rows[later] == rows[i]
            near = equal.sum(1) >= LEAST_EQUAL
            if tree is not None:
                shared = equal[:, : TREES * LEAST_DEPTH].reshape(-1, TREES, LEAST_DEPTH).all(2)
                shared &= (crowded[i] >> np.arange(TREES)) & 1 == 0
                near &= np.where(shared.any(1), shared.argmax(1), -1) == tree
            yield i, later[near]
