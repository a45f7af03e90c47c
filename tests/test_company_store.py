import uuid

import pytest
from pyspark.sql import functions as F

from dialmesh.operators import block_search
from dialmesh.operators.companies import STORE_SCHEMA
from dialmesh.session import child_folders
from dialmesh.sources.captures import CAPTURE_SCHEMA, stream_captures
from dialmesh.sources.company_store import CompanyStore
from dialmesh.sources.company_table import ConcurrentWrite
from dialmesh.streaming import scrape_stream

from test_search import bm25, make_store

ROWS = [(f"c{i}.example", f"https://c{i}.example", f"C{i}", "", [f"C{i}"], ["old"]) for i in range(60)]


@pytest.fixture
def store(spark, tmp_path):
    store = CompanyStore(spark, str(tmp_path / "store"), f"s_{uuid.uuid4().hex}", parts=8)
    store.create(spark.createDataFrame(ROWS, STORE_SCHEMA))
    return store


def rows(df):
    return {r["id"]: r for r in df.collect()}


def numbers(store):
    return {i: r["phone_numbers"] for i, r in rows(store.read()).items()}


def update(spark, *values):
    return spark.createDataFrame([*values], "url string, phone_numbers array<string>, n int")


def test_untouched_partitions_keep_their_files(spark, store):
    assert {i: tuple(r) for i, r in rows(store.read()).items()} == {r[0]: r for r in ROWS}
    assert len(store.version().folders) == 8 and store.version().batch is None
    before, files = store.version().folders, set(store.read().inputFiles())
    old = store.read()
    rejects = store.update(update(spark, ("https://c7.example/x", ["1"], 1), ("c7.example", ["2"], 2), ("none.example", ["3"], 1),
                                  ("bad host", ["4"], 1)), "n")
    assert sorted(map(tuple, rejects.collect())) == [("bad host", "invalid_url"), ("none.example", "not_found")]
    after = store.version().folders
    changed = [part for part in before if after[part] != before[part]]
    assert len(changed) == 1 and len(files & set(store.read().inputFiles())) == len(files) - 1
    assert numbers(store) == {r[0]: ["2"] if r[0] == "c7.example" else ["old"] for r in ROWS}
    assert rows(old)["c7.example"]["phone_numbers"] == ["old"]  # a reader of the old version still has it
    # an update of unknown ids alone rewrites nothing
    store.update(update(spark, ("none.example", ["3"], 1)))
    assert store.version().folders == after


def test_lookup_reads_one_partition(spark, store):
    found = store.get("http://c9.example:81/x")
    assert [r["commercial_name"] for r in found.collect()] == ["C9"] and len(found.inputFiles()) == 1
    assert store.get("none.example").isEmpty()
    with pytest.raises(ValueError, match="invalid_url"):
        store.get("bad host")


def test_upsert_and_fields(spark, store):
    new = spark.createDataFrame([("https://c3.example", "first", 1), ("c3.example", "second", 2), ("z.example", "Z", 1), ("bad host", "x", 1)],
                                "domain string, commercial_name string, n int")
    before = store.version().folders
    assert store.upsert(new, ["n"], batch=5) and not store.upsert(new.limit(1), ["n"], batch=5) and store.version().batch == 5
    got = rows(store.read())
    assert len(got) == 61 and (got["c3.example"]["commercial_name"], got["c3.example"]["phone_numbers"]) == ("second", None)
    assert got["z.example"]["commercial_name"] == "Z" and sum(store.version().folders[p] != f for p, f in before.items()) <= 2
    change = spark.createDataFrame([("z.example", "legal_name", '"L"', 1), ("z.example", "colour", '"L"', 1)],
                                   "url string, field string, value_json string, n int")
    assert [tuple(r) for r in store.update_fields(change, "n").collect()] == [("z.example", "invalid_params")]
    assert rows(store.read())["z.example"]["legal_name"] == "L" and store.version().batch == 5


def listed(store):
    return sorted(map(tuple, store.read_numbers().select("number", "id").collect()))


def test_numbers_follow_the_companies(spark, store):
    assert listed(store) == sorted(("old", r[0]) for r in ROWS)
    assert len(store.version().numbers) == 8  # one hot number, dealt by id
    number = "+1 541-754-3010"
    before = store.version().numbers
    store.update(update(spark, ("c1.example", [number, number, "x"], 1), ("c2.example", [number], 1)))
    after = store.version().numbers
    assert listed(store) == sorted([("old", r[0]) for r in ROWS[:1] + ROWS[3:]] + [(number, "c1.example"), (number, "c2.example"), ("x", "c1.example")])
    assert 0 < sum(after[p] != f for p, f in before.items()) <= 5
    rejects = store.update(update(spark, ("c3.example", ["old"], 1)))  # the same list again: its pairs stay
    assert rejects.isEmpty() and store.version().numbers == after
    found = store.search_phone("(541) 754-3010").collect()
    assert [(r["rank"], r["total"], r["id"], r["phone_numbers"]) for r in found] == [
        (1, 2, "c1.example", [number, number, "x"]), (2, 2, "c2.example", [number])]
    queries = spark.createDataFrame([(1, "541.754.3010"), (2, "5417543010"), (3, "bad"), (4, "541-754-3999"), (None, None)], "query_id int, phone string")
    got = sorted((r["query_id"], r["rank"], r["id"]) for r in store.search_phones(queries).collect())
    assert got == [(q, n, f"c{n}.example") for q in (1, 2) for n in (1, 2)]
    with pytest.raises(ValueError, match="invalid_number"):
        store.search_phone("123")
    store.upsert(spark.createDataFrame([("c1.example", 1)], "domain string, n int"), ["n"])
    assert [r["id"] for r in store.search_phone("541-754-3010").collect()] == ["c2.example"]


def test_number_search_reads_its_files_only(spark, tmp_path):
    rows = [(f"d{i}.example", "", "", "", [], [f"+1 541-754-{i:04d}"]) for i in range(400)]
    store = CompanyStore(spark, str(tmp_path / "s"), f"s_{uuid.uuid4().hex}", parts=64)
    store.create(spark.createDataFrame(rows, STORE_SCHEMA))
    asked = spark.createDataFrame([("+1 541-754-0123",)], "number string")
    read = store.read_numbers(asked)
    assert len(read.inputFiles()) <= 16 and len(store.read_numbers().inputFiles()) == 64
    assert [r["id"] for r in read.collect()] == ["d123.example"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(number,+1 541-754-0123)" in plan
    assert [r["id"] for r in store.search_phone("541-754-0123").collect()] == ["d123.example"]


def test_empty_store_and_changes(spark, tmp_path):
    store = CompanyStore(spark, str(tmp_path / "s"), f"s_{uuid.uuid4().hex}", parts=4)
    store.create()
    assert store.read().isEmpty() and store.version().folders == {} and store.get("a.example").isEmpty()
    assert [r["error"] for r in store.update(update(spark, ("a.example", ["1"], 1))).collect()] == ["not_found"]
    store.upsert(spark.createDataFrame([], "domain string, n int"), ["n"], batch=0)
    assert store.read().isEmpty() and store.version().batch == 0


def test_other_writer_and_failed_write(spark, store, monkeypatch):
    before = store.version()
    other = CompanyStore(spark, store.location, store.name, parts=8)
    place = store._folder

    def switch_in_between(kind):
        if kind == "version":
            monkeypatch.setattr(store, "_folder", place)
            other.update(update(spark, ("c1.example", ["other"], 1)))
        return place(kind)

    monkeypatch.setattr(store, "_folder", switch_in_between)
    with pytest.raises(ConcurrentWrite):
        store.update(update(spark, ("c2.example", ["lost"], 1)), batch=1)
    assert numbers(store)["c2.example"] == ["old"] and numbers(store)["c1.example"] == ["other"]
    assert store.version().batch is None and store.version() != before
    assert store.remove_old() > 0 and store.remove_old() == 0
    assert numbers(store)["c1.example"] == ["other"] and len(numbers(store)) == 60


def test_stream_counts_each_batch_once(spark, store, tmp_path, monkeypatch):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    schema = spark.createDataFrame([], CAPTURE_SCHEMA).schema

    def arrive(*pages):
        captures = spark.createDataFrame([(u, 200, None, b) for u, b in pages], CAPTURE_SCHEMA)
        captures.coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = stream_captures(spark, source, schema)
        scrape_stream.start_store_stream(stream, store, checkpoint).awaitTermination()

    def now():
        return {i: n for i, n in numbers(store).items() if n != ["old"]}

    arrive(("https://c1.example/1", "541-754-3010"), ("https://c1.example/2", "541-754-3011 541-754-3010"), ("https://c2.example", "541-754-3012"))
    run()
    first = {"c1.example": ["+1 541-754-3010", "+1 541-754-3011"], "c2.example": ["+1 541-754-3012"]}
    assert now() == first and store.version().batch == 0
    # the write of the second batch fails when its partitions are written, but not the version
    arrive(("https://c1.example/3", "541-754-3013"), ("https://c2.example", "nothing new"), ("https://c3.example", "541-754-3014"))
    place = store._folder

    def fail(kind):
        if kind == "version":
            raise OSError("no space")
        return place(kind)

    monkeypatch.setattr(store, "_folder", fail)
    with pytest.raises(Exception, match="no space"):
        run()
    assert now() == first and store.version().batch == 0
    monkeypatch.setattr(store, "_folder", place)
    run()
    second = first | {"c1.example": ["+1 541-754-3013"], "c3.example": ["+1 541-754-3014"]}
    assert now() == second and store.version().batch == 1
    # the stream ends after the store has the third batch, before its checkpoint says so
    arrive(("https://c2.example/4", "541-754-3015"))
    merge = scrape_stream.merge_batch

    def stop_after(store, captures, batch):
        merge(store, captures, batch)
        raise OSError("stopped")

    monkeypatch.setattr(scrape_stream, "merge_batch", stop_after)
    with pytest.raises(Exception, match="stopped"):
        run()
    third = second | {"c2.example": ["+1 541-754-3015"]}
    version = store.version()
    assert now() == third and store.version().batch == 2
    monkeypatch.setattr(scrape_stream, "merge_batch", merge)
    run()
    assert now() == third and store.version() == version  # run again, skipped
    early = spark.createDataFrame([("https://c1.example", 200, None, "541-754-3099")], CAPTURE_SCHEMA)
    assert merge(store, early, 0).isEmpty() and now() == third
    assert child_folders(spark, f"{store.location}/data")


def test_names_are_found_after_each_change(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(block_search, "BLOCK", 4)
    known = make_store(11, 80)
    store = CompanyStore(spark, str(tmp_path / "store"), f"s_{uuid.uuid4().hex}", parts=8)
    store.create(spark.createDataFrame(known, STORE_SCHEMA))
    texts = ["glass", "glass auto", "Café café the", "42 x_1 bay tea", "unheard", "", "co", "fresh", "on fresh glass"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, name string")
    with pytest.raises(ValueError, match="index_names"):
        store.search_names(queries)

    def holds(now):
        want = []
        for i, text in enumerate(texts):
            hits = bm25(now, text)
            want += [(i, n, key, score, len(hits)) for n, (score, key) in enumerate(hits[:10], 1)]
        return sorted((r["query_id"], r["rank"], r["id"], r["score"], r["total"]) for r in store.search_names(queries).collect()) == sorted(want)

    store.index_names()
    index = store.version().index
    assert holds(known)
    # new names, a new company, one that differs in its numbers only
    other = {r[0]: r for r in make_store(12, 80)[:30]}
    other["new.example"] = ("new.example", "https://new.example", "Fresh glass on", "", ["fresh fresh"], None)
    other[known[40][0]] = (*known[40][:5], ["+1 541-754-0000"])
    changed = spark.createDataFrame(list(other.values()), STORE_SCHEMA).withColumn("n", F.lit(1))
    store.upsert(changed, ["n"], batch=1)
    now = {r[0]: r for r in known} | other
    assert store.version().index == index and len(store.version().names) == 1 and holds(now.values())
    assert known[40][0] not in {r["id"] for r in spark.read.parquet(*store.version().names).collect()}
    # back to the first names, and every company with one word made to lose it
    back = {r[0]: r for r in known[:15]} | {k: (*r[:2], "None", "", [], None) for k, r in now.items() if "glass" in bm25_words(r) and k > "c15"}
    store.upsert(spark.createDataFrame(list(back.values()), STORE_SCHEMA).withColumn("n", F.lit(1)), ["n"], batch=2)
    now |= back
    assert len(store.version().names) == 2 and holds(now.values())
    unheard = store.search_names(queries.where("query_id = 4"))  # reads no partition
    assert unheard.isEmpty() and not [f for f in unheard.inputFiles() if store.location in f]
    # merged: same pages from the index alone
    store.index_names()
    assert store.version().names == () and store.version().index != index and holds(now.values())
    assert store.remove_old() > 0 and holds(now.values())
    # numbers alone change no name
    store.update(update(spark, (known[3][0], ["+1 541-754-0001"], 1)))
    assert store.version().names == ()


def bm25_words(row):
    return " ".join([row[2], row[3], *row[4]]).lower().split()
