import json
import uuid

import pytest

from dialmesh.operators import companies as ops
from dialmesh.plans.directory import build_index, import_companies
from dialmesh.operators.search import search_by_name
from dialmesh.sources import company_json as cj
from dialmesh.sources.company_table import CompanyTable
from dialmesh.sources.lists import ListError

STORE = [
    ("a.example", "https://a.example", "A Shop", "", ["A Shop"], ["+1 541-754-3010"]),
    ("b.example", "https://b.example", "B", "B INC.", ["B", "Bee"], None),
    ("c.example", "http://c.example", "C", "", [""], []),
]


@pytest.fixture
def store(spark):
    return spark.createDataFrame(STORE, ops.STORE_SCHEMA)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_json(spark, store):
    docs = {json.loads(r[0])["id"]: r[0] for r in store.select(cj.company_json()).collect()}
    assert docs["a.example"] == (
        '{"domain":"https://a.example","commercial_name":"A Shop","legal_name":"",'
        '"all_available_names":["A Shop"],"id":"a.example","phone_numbers":["+1 541-754-3010"]}')
    assert "phone_numbers" not in docs["b.example"] and "phone_numbers" not in docs["c.example"]
    plain = store.where("id = 'c.example'").select(cj.company_json(with_id=False)).first()[0]
    assert plain == '{"domain":"http://c.example","commercial_name":"C","legal_name":"","all_available_names":[""]}'
    back = spark.createDataFrame([(docs["b.example"],)], "d string").select(cj.parse_company_json("d").alias("c"))
    row = back.select("c.*").first()
    assert (row["id"], row["all_available_names"], row["phone_numbers"]) == ("b.example", ["B", "Bee"], None)


def test_write_json(spark, store, tmp_path):
    cj.write_company_json(store, str(tmp_path / "out"))
    read = spark.read.json(str(tmp_path / "out"))
    assert {r["id"] for r in read.collect()} == {"a.example", "b.example", "c.example"}


def test_get(spark, store):
    urls = ["https://a.example:80/x", " b.example", "zzz.example", "bad host", "", "c.example", "c.example"]
    out = ops.get_companies(store, spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    got = sorted((r["url"], r["id"], r["commercial_name"], r["error"]) for r in out if r["id"])
    assert got == sorted([
        ("https://a.example:80/x", "a.example", "A Shop", None), (" b.example", "b.example", "B", None),
        ("zzz.example", "zzz.example", None, "not_found"),
        ("c.example", "c.example", "C", None), ("c.example", "c.example", "C", None)])
    assert sorted((r["url"], r["error"]) for r in out if not r["id"]) == [
        ("", "missing_host"), ("bad host", "invalid_url")]
    assert ops.get_company(store, "http://b.example/").first()["legal_name"] == "B INC."
    assert ops.get_company(store, "none.example").isEmpty()
    with pytest.raises(ValueError, match="invalid_url"):
        ops.get_company(store, "bad host")


def test_upsert_replaces_whole_records(spark, store):
    new = spark.createDataFrame(
        [("https://a.example", "first", 1), ("https://a.example:8080/x", "second", 2), ("https://d.example", "D", 3),
         ("bad host", "x", 4)],
        "domain string, commercial_name string, n int")
    out = by_id(ops.upsert_companies(store, new, ["n"]))
    assert set(out) == {"a.example", "b.example", "c.example", "d.example"}
    assert (out["a.example"]["commercial_name"], out["a.example"]["phone_numbers"]) == ("second", None)
    assert out["b.example"]["legal_name"] == "B INC."


def test_partial_update(spark, store):
    updates = spark.createDataFrame(
        [("https://a.example", ["x", "y"], None, 1), ("b.example", ["1"], "old", 1), ("b.example/z", None, "new", 2),
         ("b.example", ["2"], None, 3), ("nope.example", ["1"], None, 1), ("bad host", ["1"], None, 1)],
        "url string, phone_numbers array<string>, legal_name string, n int")
    result = ops.update_companies(store, updates, "n")
    out = by_id(result.store)
    assert (out["a.example"]["phone_numbers"], out["a.example"]["commercial_name"]) == (["x", "y"], "A Shop")
    assert (out["b.example"]["phone_numbers"], out["b.example"]["legal_name"]) == (["2"], "new")
    assert tuple(out["c.example"]) == STORE[2]
    assert sorted(map(tuple, result.rejects.collect())) == [
        ("bad host", "invalid_url"), ("nope.example", "not_found")]


def test_update_field(spark, store):
    changes = spark.createDataFrame(
        [("a.example", "legal_name", '"A \\"x\\" INC."', 1), ("a.example", "phone_numbers", "null", 2),
         ("b.example", "all_available_names", '[ "x", "y, z" ]', 1), ("b.example", "legal_name", '"1"', 1),
         ("b.example", "legal_name", '"2"', 2), ("b.example", "colour", '"red"', 3), ("b.example", "domain", "5", 3),
         ("b.example", "domain", '"x', 3), ("b.example", "phone_numbers", "[1]", 3), ("b.example", "phone_numbers", None, 3),
         ("c.example", "phone_numbers", "[]", 1), ("none.example", "domain", '"x"', 1)],
        "url string, field string, value_json string, n int")
    result = ops.update_fields(store, changes, "n")
    out = by_id(result.store)
    assert (out["a.example"]["legal_name"], out["a.example"]["phone_numbers"]) == ('A "x" INC.', None)
    assert (out["b.example"]["all_available_names"], out["b.example"]["legal_name"]) == (["x", "y, z"], "2")
    assert out["b.example"]["domain"] == "https://b.example"
    rejects = sorted(map(tuple, result.rejects.collect()))
    assert rejects == [("b.example", "invalid_params")] * 5 + [("none.example", "not_found")]


def test_table_versions(spark, store, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    table = CompanyTable(spark, str(tmp_path / "store"), name, buckets=3)
    with pytest.raises(ValueError, match="invalid_index"):
        table.create("other")
    assert table.create(name).count() == 0
    lines = tmp_path / "list.csv"
    header = "domain,company_commercial_name,company_legal_name,company_all_available_names\n"
    lines.write_text(header + "a.example,A,,A\nb.example,Glass,,G | H\na.example,A2,,A\n")
    assert tuple(import_companies(spark, table, str(lines)).first()) == (3, 0)
    assert {r["id"]: r["commercial_name"] for r in table.read().collect()} == {"a.example": "A2", "b.example": "Glass"}
    numbers = spark.createDataFrame([("a.example", ["1"]), ("z.example", ["2"])], "url string, phone_numbers array<string>")
    assert [tuple(r) for r in table.update(numbers).collect()] == [("z.example", "not_found")]
    assert by_id(table.read())["a.example"]["phone_numbers"] == ["1"]
    change = spark.createDataFrame([("b.example", "legal_name", '"L"', 1)], "url string, field string, value_json string, n int")
    assert table.update_fields(change, "n").isEmpty()
    assert by_id(table.read())["b.example"]["legal_name"] == "L"
    index = build_index(table, str(tmp_path / "index"))
    assert [r["id"] for r in search_by_name(table.read(), "glass", index).collect()] == ["b.example"]
    import_companies(spark, table, str(lines))
    assert by_id(table.read())["a.example"]["phone_numbers"] is None  # a re-import drops them
    lines.write_text(header + "bad host,A,,A\n")
    with pytest.raises(ListError):
        import_companies(spark, table, str(lines))
    # The key of a lookup reaches the files.
    plan = ops.get_company(table.read(), "http://a.example:80/x")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,a.example)" in plan
    # A join with the store on its key shuffles only the other side.
    plan = table.read().hint("merge").join(numbers.withColumnRenamed("url", "id"), "id")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1


def test_documents_with_errors(column):
    documents = [
        '{"domain":"https://a.example","commercial_name":"A","id":"a.example"}', '{bad', "", None, '{"domain":"http://a b"}',
        '{"commercial_name":"x"}', '{"domain":"redis://a.example"}',
    ]
    got = column(documents, cj.read_company_json)
    assert [r["error"] for r in got] == [None, "parse_error", "parse_error", "parse_error", "invalid_url", "missing_host", "invalid_scheme"]
    assert got[0]["company"]["id"] == "a.example" and all(r["company"] is None for r in got[1:])
