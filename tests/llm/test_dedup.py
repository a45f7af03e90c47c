"""Near-duplicate and substring operators against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dialmesh.llm.components import connected_components
from dialmesh.llm import embedding_dedup
from dialmesh.llm.embedding_dedup import embedding_duplicates, quantise
from dialmesh.llm import minhash_dedup, substring_dedup, word_hashes
from dialmesh.llm.minhash_dedup import SORTED, _nearest, near_duplicates
from dialmesh.llm.substring_dedup import cut_repeats, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, links):
    part = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(part[a], part[b])
            changed |= part[a] != low or part[b] != low
            part[a] = part[b] = low
    return part


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(1, 1), (3, None)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(500, 400), (500, 400)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert {r["node"]: r["component"] for r in got} == components({x for l in real for x in l}, real)
    assert len(got) == len({r["node"] for r in got})
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quantisation_bound():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(200, 33)), rng.normal(size=(200, 33)) ** 5, np.zeros((1, 33))])
    q, scale, error = quantise(x)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    unit = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    near = (q.astype(int) @ q.astype(int).T) * scale[:, None] * scale
    bound = error[:, None] + (1 + error[:, None]) * error
    assert (np.abs(unit @ unit.T - near) <= bound + 1e-12).all() and bound.mean() < 0.2


@pytest.mark.parametrize("kind,block_rows", [("float", 8192), ("float", 16), ("double", 40)])
def test_embeddings(spark, kind, block_rows):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(size=24) * rng.choice([0.02, 0.3, 0.45, 1.0])).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # copies
    rows += [(300, None), (301, [0.0] * 24), (302, [float("nan")] + rows[0][1][1:]), (303, [None] + rows[0][1][1:]),
             (304, [float("inf")] * 24), (305, []), (306, rows[0][1][:10]), (5, rows[30][1])]
    schema = f"vec_id long, embedding array<{kind}>, n_links string, id int"
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], schema).repartition(3)
    got = embedding_duplicates(df, block_rows=block_rows).collect()
    usable = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, count = [], collections.Counter()
    for a, (i, x) in enumerate(usable):
        for j, y in usable[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                links.append((i, j))
                count.update([i, j])
    part = components({i for i, _ in rows}, links)
    assert len(got) == len(rows) and len(links) > 500
    summed = collections.Counter()
    for r in got:
        summed[r["vec_id"]] += r["n_links"]
        assert (r["component_id"], r["kept"]) == (part[r["vec_id"]], part[r["vec_id"]] == r["vec_id"])
    assert +summed == +count
    assert embedding_duplicates(df.where("false")).count() == 0


def turned(degrees):
    return [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]


@pytest.mark.parametrize("order", [(0, 1, 2), (0, 2, 1), (1, 0, 2), (2, 1, 0)])
@pytest.mark.parametrize("block_rows", [1, 8192])
def test_a_vector_without_key_leads_on(spark, order, block_rows):
    rows = [(7, turned(0)), (None, turned(20)), (3, turned(40))]
    df = spark.createDataFrame([rows[k] for k in order] + [(7, None), (9, None), (None, None)], "vec_id int, embedding array<double>")
    got = embedding_duplicates(df.coalesce(1), block_rows=block_rows).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(7, 1, 3, False), (None, 2, 3, False), (3, 1, 3, True), (7, 0, 3, False), (9, 0, 9, True), (None, 0, None, False)], key=str)


def test_tiles_do_not_grow_with_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one class
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = {}
    for parts in (1, 60):
        plain = embedding_dedup.materialize(embedding_dedup._rows(df.repartition(parts), "vec_id", "embedding"))
        classes = plain.groupBy("print", "print2", "dim").agg(F.min("row").alias("class"), F.count("row").alias("copies"))
        small = embedding_dedup.quantised(plain, classes, 250).collect()
        assert len(small) == 700 and sum(r["copies"] for r in small) == 1000
        made[parts] = sorted((r["q"], r["block"]) for r in small)
    assert made[1] == made[60] and len({b for _, b in made[1]}) == 3


@pytest.mark.parametrize("dim,threshold", [(1500, 0.9), (40, 1.0), (3, 0.5)])
def test_links_decided_by_bounds_and_in_full(spark, dim, threshold):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=dim)
    spread = 0.0 if threshold == 1 else np.sqrt(1 / threshold - 1)  # cosines round the threshold
    x = [base + spread * rng.normal(size=dim) for _ in range(150)] + [2 * base, 3.5 * base, -base]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_duplicates(df, threshold, block_rows=60).collect()}
    near = lambda a, b: (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()) >= threshold
    want = {i: sum(bool(near(a, b)) for j, b in enumerate(x) if i != j) for i, a in enumerate(x)}
    if threshold < 1:
        assert got == want and 0 < sum(want.values()) < 150 * 149
    else:  # multiples of one vector round either way, copies do not
        assert set(got) == set(want) and sum(got[i] for i in range(150)) >= 150 * 149


def documents():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    long = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, long(rng.randint(1, 120))) for i in range(120)]
    base = long(200).split()
    for i in range(60):  # near copies
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(200)] = word()
        rows.append((200 + i, " ".join(copy)))
    passage = long(50)
    for i in range(50):  # a passage within otherwise different texts
        rows.append((300 + i, f"{long(rng.randint(0, 60))}\n{passage}\t {long(rng.randint(0, 60))}"))
    rows += [(400 + i, rows[3][1]) for i in range(20)]
    rows += [(430, None), (431, ""), (432, " \n\t "), (433, "one two"), (434, "ONE two"), (435, "x " * 90), (436, base[0].upper()),
             (437, "É é " * 9), (438, rows[130][1].upper()), (440, " ".join(base) + " " + " ".join(base)), (441, long(6000))]
    return rows


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


@pytest.mark.parametrize("region", [256, 3])
def test_near_duplicates(spark, region):
    rows = documents()
    sets = {i: shingles(t) for i, t in rows}
    links = []
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= 75 * len(a | b):
                links.append((i, j))
    part = components(sets, links)
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id int, text string, component_id string, n int")
    got = near_duplicates(df.repartition(3), region=region).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(s), part[i], part[i] == i) for i, s in sets.items()
    }
    assert len(got) == len(rows)


def test_recall_at_the_threshold(spark):
    """Pairs of a similarity of exactly 0.75, just above and just below."""
    rows, linked = [], {}
    for i in range(900):
        own = 19 + i % 3  # 120 shingles in common, ``own`` of each text's own
        common = [f"w{i}c{k}" for k in range(124)]
        for side in (0, 1):
            rows.append((2 * i + side, " ".join(common + [f"w{i}s{side}k{k}" for k in range(own)])))
        linked[2 * i] = 100 * 120 >= 75 * (120 + 2 * own)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    found = sum(got[i + 1] == i for i, is_link in linked.items() if is_link)
    assert found >= 0.99 * 600 == 0.99 * sum(linked.values())
    assert all(got[i + 1] == i + 1 for i, is_link in linked.items() if not is_link)


def test_neighbours_in_sorted_orders(spark):
    rng = random.Random(23)
    rows = [(region, one, 3 + region % 4, bytes(rng.choice((0, 0, 200)) for _ in range(4 * SORTED)))
            for region in range(12) for one in rng.sample(range(60), rng.choice((2, 9, 30)))]
    rows += [(50, one, 64, b"") for one in (100, 101, 102)] + [(51, one, 60, bytes(16)) for one in (104, 105)]
    common = collections.defaultdict(int)
    for region, one, depth, rest in rows:
        for other_region, other, _, other_rest in rows:
            if region == other_region and one != other:
                parts = [rest[4 * k : 4 * k + 4] == other_rest[4 * k : 4 * k + 4] for k in range(len(rest) // 4)]
                length = depth + (parts + [False]).index(False)
                common[one, other] = max(common[one, other], length)
    df = spark.createDataFrame(rows, "region long, one long, depth int, rest binary").repartition(3)
    got = {r["one"]: r["leader"] for r in _nearest(df).collect()}
    assert set(got) == {one for one, _ in common}
    for one, other in got.items():
        assert common[one, other] == max(n for (a, _), n in common.items() if a == one)


def test_near_duplicates_beside_a_crowd(spark):
    """1,200 variants of one text, and documents that link with one variant each."""
    rng = random.Random(16)
    base, rows = [f"w{k}" for k in range(400)], []
    for i in range(1200):
        copy = list(base)
        for k in rng.sample(range(60), 4):
            copy[6 * k] = f"v{i}x{k}"
        rows.append((i, " ".join(copy)))
    for i in range(60):  # a rewritten end, too far from all but its variant
        words = rows[rng.randrange(1200)][1].split()
        rows.append((5000 + i, " ".join(words[:344] + [f"e{i}y{k}" for k in range(56)])))
    sets = {i: shingles(t) for i, t in rows}
    near = lambda i, j: 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    beside = [(j, i) for i in range(5000, 5060) for j in range(1200) if near(i, j)]
    assert [i for _, i in beside] == list(range(5000, 5060))
    assert all(near(0, i) for i in range(1200))
    part = components(sets, beside + [(0, i) for i in range(1200)])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()} == part


def test_depths_are_counted_in_few_steps(spark, monkeypatch):
    """Regions of adaptive depth as by plain counting, over all depths in three passes."""
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 3, (60, 64)).astype(np.uint32)
    rows[:25] = rows[0]
    rows[5:25, 50:] = rng.integers(0, 3, (20, 14))
    df = spark.createDataFrame([(i, r.tobytes()) for i, r in enumerate(rows)], "one long, signature binary")
    passes = []
    monkeypatch.setattr(minhash_dedup, "map_batches", lambda df, make, kind, f=minhash_dedup.map_batches: passes.append(1) or f(df, make, kind))
    got = minhash_dedup._regions(df, 4)[0].where("depth < 64").groupBy("region", "depth").agg(F.sort_array(F.collect_list("one")).alias("ones"))
    got = sorted((r["depth"], tuple(r["ones"])) for r in got.collect())
    want = []
    for tree in range(21):
        active = set(range(60))
        for depth in (3, 5, 8, 12, 18, 27, 40):
            groups = collections.defaultdict(list)
            for i in sorted(active):
                groups[tuple(rows[i][(3 * tree + np.arange(depth)) % 64])].append(i)
            want += [(depth, tuple(g)) for g in groups.values() if 1 < len(g) <= 4]
            active = {i for g in groups.values() if len(g) > 4 for i in g}
    assert got == sorted(want) and {d for d, _ in got} >= {3, 5, 8}
    assert len(passes) == 3


def test_a_pair_of_a_crowd_is_compared_in_one_tree():
    rows = np.arange(3 * 64, dtype=np.uint32).reshape(3, 64)
    rows[1, 6:] = rows[0, 6:]  # trees 2 to 20 are shared
    kept = []
    for tree in range(2, 21):
        region = pa.table({"component": [0, 1], "n": [9, 9], "signature": [r.tobytes() for r in rows[:2]], "tree": pa.array([tree] * 2, pa.int32())})
        kept += [(tree, i, p.tolist()) for i, p in minhash_dedup._possible(region, 75) if len(p)]
    assert kept == [(2, 0, [1])]


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "p q r s t u"), (None, "a b c d e f"), (None, None), (3, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, None, True), (None, None, True)]
    assert near_duplicates(df.where("false")).count() == 0


def repeats(rows, size):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[k : k + size]) for w in words for k in range(len(w) - size + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("size,hot", [(35, 128), (35, 1), (12, 4)])
def test_remove_repeats(spark, size, hot):
    rows = documents() + [(3, documents()[3][1]), (None, "lonely"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, start string, n_words int")
    got = remove_repeats(df.repartition(3), size=size, hot=hot).collect()
    want = repeats(rows, size)
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=order) == sorted((w[:4] for w in want), key=order)
    assert sum(w[2] for w in want) > 3000


def test_cut_repeats(spark):
    rows = documents()
    df = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, id string")
    cut = cut_repeats(df)
    assert cut.columns == df.columns
    want = {i: kept if removed else text for (i, text), (_, _, removed, _, kept) in zip(rows, repeats(rows, 35))}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want
    assert cut_repeats(df.where("false")).count() == 0


def test_many_equal_rows(spark):
    rng = random.Random(44)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(150)]
    text = " ".join(base)
    rows = [(1, text)] * 3000 + [(2, " ".join([word() for _ in range(50)] + base[20:90])), (3, " ".join(word() for _ in range(60)))] + [(None, "n " * 50)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collections.Counter(tuple(r) for r in remove_repeats(df).collect())
    assert got == collections.Counter(w[:4] for w in repeats(rows, 35))
    left = collections.Counter((r["doc_id"], r["text"]) for r in cut_repeats(df).collect())
    assert left[1, ""] == 3000 and left[None, ""] == 2 and sum(left.values()) == len(rows)


def test_texts_do_not_move_for_their_sets(spark, monkeypatch):
    made = []
    monkeypatch.setattr(minhash_dedup, "BucketedTable", lambda df, key: made.append(df))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    texts = [(i, f"{i} a b c d e f {i}") for i in range(50)] + [(3, "other words"), (4, "4 a b c d e f 4"), (None, "3 a")]
    prints = [(i, *minhash_dedup._print(minhash_dedup.shingle_sets(pa.array([t]))[0])) for i, t in texts[:40]]
    ends = spark.createDataFrame(prints, "one long, print long, print2 long")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for it
        minhash_dedup._sets(spark.createDataFrame(texts, "id long, text string"), ends)
        plan = made[0]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # sets and ends, each once
        got = sorted((r["one"], r["n"], bytes(r["shingles"])) for r in made[0].collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    sets = minhash_dedup.shingle_sets(pa.array([t for _, t in texts[:40]]))
    assert got == [(i, len(s), s.tobytes()) for i, s in enumerate(sets)]


def test_a_pair_is_compared_in_one_whole_region():
    """Crowded trees and deeper regions count only where no region of the least depth is whole."""
    rows = np.arange(3 * 64, dtype=np.uint32).reshape(3, 64)
    rows[1, 6:] = rows[0, 6:]  # trees 2 to 20 are shared
    whole = lambda *crowded: sum(1 << t for t in crowded)
    for crowded, first in ((0, 2), (whole(2, 3), 4), (whole(*range(2, 21)), -1)):
        kept = []
        for tree in range(-1, 21):
            region = pa.table({
                "component": [0, 1], "n": [9, 9], "signature": [r.tobytes() for r in rows[:2]],
                "tree": pa.array([tree] * 2, pa.int32()), "crowded": [crowded] * 2,
            })
            kept += [(tree, i, p.tolist()) for i, p in minhash_dedup._possible(region, 75) if len(p)]
        assert kept == [(first, 0, [1])]


def test_rows_of_single_documents_do_not_move_for_regions(spark, monkeypatch):
    """What is written of the regions' rows are those of shared regions, for all later joins."""
    rng = np.random.default_rng(6)
    rows = rng.integers(0, 2**32, (300, 64), dtype=np.uint32)
    rows[1] = rows[0]
    df = spark.createDataFrame([(i, r.tobytes()) for i, r in enumerate(rows)], "one long, signature binary")
    written = []
    monkeypatch.setattr(minhash_dedup, "materialize", lambda df, f=minhash_dedup.materialize: written.append(f(df)) or written[-1])
    found, _, crowd = minhash_dedup._regions(df, 4)
    assert crowd is None and sorted((r["tree"], r["one"]) for r in found.collect()) == [(t, i) for t in range(21) for i in (0, 1)]
    sizes = [d.count() for d in written if "rest" in d.columns]
    assert all(42 <= n < 21 * 30 for n in sizes)  # of 21 * 300


# memory of a worker


def test_word_hashes_need_little_memory():
    """Arrays of numbers per byte are bounded: 2 MB of text took 97 MB at a time."""
    import tracemalloc

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 12))) for _ in range(5000)] + ["x" * 300_000, "é" * 90]
    words = word_hashes.split_words(pa.array([" ".join(rng.choices(words[:5000], k=300_000)), " ".join(words)]))
    tracemalloc.start()
    try:
        hashes = words.hashes()
        assert tracemalloc.get_traced_memory()[1] < 50_000_000
    finally:
        tracemalloc.stop()
    for i in [0, 1, 299_999, 300_000, *range(305_000 - 5, len(words))]:
        alone = pa.array([words.data[words.start[i] : words.end[i]].tobytes().decode()])
        assert word_hashes.split_words(alone).hashes()[0] == hashes[i]
    assert len(word_hashes.split_words(pa.array([" "])).hashes()) == 0


def test_buckets_are_counted_in_parts_of_a_bounded_size(monkeypatch):
    """A whole batch of strings was counted at once; parts end where buckets do, and give the same rows."""
    rng = random.Random(5)
    rows = []
    for bucket in range(40):
        words = rng.choices("abcdefghij", k=60)
        for i in range(rng.randint(1, 6)):
            text = " ".join(words[i : i + 45])
            rows.append((bucket // 2, bucket % 2, bytes([bucket, i]), 1, text))
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["minimiser", "salt", "string_id", "n", "packed"])
    parts = []
    plain = substring_dedup._windows_of

    def noted(table, size):
        parts.append(table)
        return plain(table, size)

    def run():
        batches = [batch.slice(i, 25) for i in range(0, len(batch), 25)]
        out = [r for b in substring_dedup._count_windows(35)(batches) for r in b.to_pylist()]
        return sorted((r["string_id"] or b"", tuple(r["windows"] or ()), tuple(r["open"] or ()), frozenset(r["seen"] or ())) for r in out if r["string_id"]), {
            p for r in out for p in r["seen"] or ()
        }

    monkeypatch.setattr(substring_dedup, "_windows_of", noted)
    whole = run()
    parts.clear()
    monkeypatch.setattr(substring_dedup, "TEXT_BYTES", 400)
    assert run() == whole
    assert sum(map(len, parts)) == len(rows)
    own = [set(zip(*(t.column(i).to_pylist() for i in (0, 1)))) for t in parts]
    assert len(own) == 40 or all(sum(map(len, t.column(4).to_pylist())) <= 400 for t, o in zip(parts, own) if len(o) > 1)
    assert sum(map(len, own)) == 40  # no bucket is in two parts
