import random

import pytest

from dialmesh.operators import block_search as ops
from dialmesh.operators.companies import STORE_SCHEMA
from dialmesh.operators.search import name_hits, name_index, search_result

from test_search import bm25, make_store


@pytest.fixture(scope="module")
def small_blocks():
    before, ops.BLOCK = ops.BLOCK, 4
    yield
    ops.BLOCK = before


def pages(df):
    return sorted((r["query_id"], r["rank"], r["id"], r["score"], r["total"]) for r in df.collect())


def test_pages_and_totals_against_brute_force(spark, small_blocks, tmp_path):
    rows = make_store(7, 90)
    store = spark.createDataFrame(rows, STORE_SCHEMA).repartition(3)
    index = ops.BlockIndex.build(store, str(tmp_path / "index"))
    texts = ["glass", "glass auto", "Café café the", "42 x_1 bay tea", "unheard", "", "co", "on on on the unheard"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, name string")
    want = []
    for i, text in enumerate(texts):
        hits = bm25(rows, text)
        want += [(i, n, key, score, len(hits)) for n, (score, key) in enumerate(hits[:10], 1)]
    assert pages(ops.search_names(index, store, queries)) == sorted(want)
    loaded = ops.BlockIndex.load(spark, str(tmp_path / "index"))
    assert {r["query_id"]: r["total"] for r in ops.search_totals(loaded, queries).collect()} == {
        i: len(bm25(rows, t)) for i, t in enumerate(texts) if bm25(rows, t)}
    assert ops.search_names(index, store, queries.where("query_id = 4")).isEmpty()
    # joined by shuffle instead of broadcast
    before, ops.BROADCAST_TERMS = ops.BROADCAST_TERMS, 0
    try:
        assert pages(ops.search_names(index, store, queries)) == sorted(want)
    finally:
        ops.BROADCAST_TERMS = before


def test_blocks_are_skipped(spark, small_blocks, tmp_path):
    rng = random.Random(3)
    rows = [(f"k{i:04d}.example", "", f"{rng.choice('abcdefgh') * 3} common trade", "", [], None) for i in range(1500)]
    rows += [(f"z{i}.example", "", "common rare", "", [], None) for i in range(12)]
    store = spark.createDataFrame(rows, STORE_SCHEMA).repartition(2)
    index = ops.BlockIndex.build(store, str(tmp_path / "index"))
    queries = spark.createDataFrame([(0, "common rare"), (1, "common")], "query_id int, name string")
    weighted = ops._weighted(index, ops._wanted(queries))
    limits = ops.block_limits(index, weighted)
    assert limits.where("query_id = 0").count() > 370
    found = ops._hits_in(index, weighted, limits.where("query_id = 0").orderBy("limit", ascending=False).limit(10))
    # of the blocks with a common word only those of the rare ones can reach the page
    opened = ops.open_blocks(limits.where("query_id = 0"), found).count()
    assert opened < 10
    scored = ops._hits_in(index, weighted, ops.open_blocks(limits.where("query_id = 0"), found)).count()
    assert scored * 20 < index.postings.where("term = 'common'").count()
    want = pages(search_result(name_hits(name_index(store), queries), store))
    assert pages(ops.search_names(index, store, queries)) == want and want[0][4] == 1512
    # totals: one row per query, term and bitmap, not one per hit
    plan = ops.search_totals(index, queries)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_or_agg" in plan and "postings" not in plan


def test_empty_index(spark, tmp_path):
    store = spark.createDataFrame([], STORE_SCHEMA)
    index = ops.BlockIndex.build(store, str(tmp_path / "index"))
    queries = spark.createDataFrame([(0, "x")], "query_id int, name string")
    assert ops.search_names(index, store, queries).isEmpty() and ops.search_totals(index, queries).isEmpty()
