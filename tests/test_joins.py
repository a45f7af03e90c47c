import pytest
from pyspark.sql import functions as F

from dialmesh import joins
from dialmesh.operators.companies import STORE_SCHEMA, get_companies
from dialmesh.operators.reachability import check_results


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [1, 50, 10_000])
def test_hot_keys_change_nothing(spark, how, hot, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", hot)
    many = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id % 200 END AS k")
    one = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, v int")
    got = joins.lookup_join(many, one, "k", how).select("id", "k", "v")
    want = many.join(one, "k", how).select("id", "k", "v")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_hot_rows_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    monkeypatch.setattr(joins, "HOT_SHARE", 1000)
    many = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id END AS k")
    one = spark.range(3000).selectExpr("'k' || id AS k", "id AS v").hint("merge")
    plan = joins.lookup_join(many, one, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and plan.count("BroadcastHashJoin") >= 3


def test_operators_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    urls = spark.range(90).selectExpr("cast(id as int) idx", "CASE WHEN id % 3 = 0 THEN 'bad host' WHEN id % 3 = 1 THEN 'a.example' ELSE 'u' || id END url")
    store = spark.createDataFrame([("a.example", "https://a.example", "A", "", [], [])], STORE_SCHEMA)
    errors = [r["error"] for r in get_companies(store, urls).collect()]
    assert (errors.count(None), errors.count("invalid_url"), errors.count("not_found")) == (30, 30, 30)
    log = spark.createDataFrame([("a.example", 200, None)], "url string, status int, error string")
    status = [r["status"] for r in check_results(urls, log).collect()]
    assert (len(status), status.count(200)) == (90, 30)


def test_bloom_filter(spark):
    keys = spark.range(20_000).selectExpr("'h' || id AS host").unionByName(spark.createDataFrame([(None,)], "host string"))
    bloom = joins.BloomFilter.build(keys, "host")
    assert bloom.n_blocks == bloom.blocks.count() == 79
    inside = bloom.keep(keys.withColumn("x", F.lit(1)), F.col("host"))
    assert inside.columns == ["host", "x"] and inside.count() == 20_000
    others = spark.range(100_000).selectExpr("'g' || id AS host")
    assert 0 < bloom.keep(others, F.col("host")).count() < 1000
    none = joins.BloomFilter.build(keys.where("false"), "host")
    assert none.keep(keys, F.col("host")).count() == 0


def test_bloom_filter_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BLOCKS", 2)
    keys = spark.range(20_000).selectExpr("'h' || id AS host")
    bloom = joins.BloomFilter.build(keys, "host")
    assert bloom.blocks.count() == 2 and bloom.keep(keys, F.col("host")).count() == 20_000
