from dialmesh.operators.companies import STORE_SCHEMA
from dialmesh.operators.phones import page_phones
from dialmesh.sources.captures import CAPTURE_SCHEMA, load_captures, stream_captures
from dialmesh.streaming import scrape_stream as ops

PAGES = "/root/testdata/sf0.01/pages.parquet"


def test_stream_equals_batch(spark, tmp_path):
    pages = spark.read.parquet(PAGES)
    pages.repartition(5, "page_id").write.parquet(str(tmp_path / "in"))
    stream = stream_captures(spark, str(tmp_path / "in"), pages.schema, body="html")
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    ops.start_scrape_stream(stream, log, checkpoint).awaitTermination()
    got = ops.read_log(spark, log).drop("batch")
    want = ops.batch_phones(load_captures(pages, body="html"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert page_phones(load_captures(pages, body="html"), ["url"]).count() > 0


def test_later_batches_replace(spark, tmp_path):
    source = str(tmp_path / "in")
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    schema = spark.createDataFrame([], CAPTURE_SCHEMA).schema

    def arrive(*rows):
        captures = spark.createDataFrame([(u, 200, None, b) for u, b in rows], CAPTURE_SCHEMA)
        captures.coalesce(1).write.mode("append").parquet(source)
        stream = stream_captures(spark, source, schema)
        ops.start_scrape_stream(stream, log, checkpoint).awaitTermination()

    arrive(("https://a.example/1", "541-754-3010"), ("https://a.example/2", "541-754-3011 541-754-3010"),
           ("https://b.example", "541-754-3012"))
    arrive(("https://a.example/3", "541-754-3013"), ("https://b.example", "nothing new"), ("bad url", "541-754-3010"))
    store = spark.createDataFrame(
        [(f"{n}.example", f"https://{n}.example", n, "", [n], ["old"]) for n in "abc"], STORE_SCHEMA)
    result = ops.apply_log(store, ops.read_log(spark, log))
    assert {r["id"]: r["phone_numbers"] for r in result.store.collect()} == {
        "a.example": ["+1 541-754-3013"], "b.example": ["+1 541-754-3012"], "c.example": ["old"]}
    assert result.rejects.isEmpty()


def test_log_before_the_first_batch_and_later_batches(spark, tmp_path):
    log = str(tmp_path / "log")
    assert ops.read_log(spark, log).isEmpty() and "batch" in ops.read_log(spark, log).columns
    row = ("a.example", "+1 541-754-3010", 0, "https://a.example", 0)
    for batch in (0, 1, 2):
        rows = spark.createDataFrame([row], "id string, number string, confidence int, url string, pos int")
        rows.write.parquet(f"{log}/batch={batch}")
    assert sorted(r["batch"] for r in ops.read_log(spark, log, after=0).collect()) == [1, 2]
