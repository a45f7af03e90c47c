"""The pipeline stage by stage against brute force, and the registered queries."""

import random

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from dialmesh.llm import queries
from dialmesh.llm.tokenizers_files import public_path
from dialmesh.session import materialize

from .test_dedup import components, repeats, shingles
from .test_filters import labelled, prose, secret_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    marked = labelled(500, 3)
    rows = [(i, t, la, "s", len(t), "extra") for i, t, la, _ in marked]
    rows += [(50_000 + i, t, "en", "s", len(t), None) for i, t, _, _ in secret_rows()]
    passage = " ".join(prose(rng, 60))
    for i in range(40):
        text = " ".join(prose(rng, 80)) + f" {passage} " + " ".join(prose(rng, 80))
        rows.append((60_000 + i, text, None, None, len(text), "e"))
    base = prose(rng, 150)
    for i in range(30):
        copy = list(base)
        copy[rng.randrange(150)] = "changed"
        rows.append((70_000 + i, " ".join(copy), "de", "s", 0, None))
    rows += [(80_000, None, None, None, None, None), (80_001, "", "en", "s", 0, None)]
    folder = str(tmp_path_factory.mktemp("tables"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, _, y in marked], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {i: y for i, _, _, y in marked}


def test_stages(spark, tables):
    folder, toxic = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder))
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r["doc_id"]: r for r in docs.collect()}
    clean, single, cut, safe = kept.values()
    wrong = [i for i, y in toxic.items() if (i in clean) == bool(y)]
    assert len(wrong) <= 15 and sum(i >= 50_000 for i in clean) >= 305
    sets = {i: shingles(r["text"]) for i, r in clean.items()}
    links = [(i, j) for i, a in sets.items() for j, b in sets.items() if i < j and a and b and 100 * len(a & b) >= 75 * len(a | b)]
    part = components(sets, links)
    assert set(single) == {i for i in sets if part[i] == i} and 70_001 not in single and 80_000 in single
    rows = [(i, r["text"]) for i, r in single.items()]
    left = {i: (k if gone else t) for (i, t), (_, _, gone, _, k) in zip(rows, repeats(rows, 35))}
    assert {i: r["text"] for i, r in cut.items()} == left
    assert all(len(r["text"].split()) < 170 for i, r in cut.items() if 60_000 <= i < 60_040)
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in cut.values())
    for i, _, found, secret in secret_rows():
        if 50_000 + i in safe:
            value = found.split('"')[1] if '"' in found else found.split("=")[-1]
            assert (value in safe[50_000 + i]["text"]) != secret
    library = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    sizes = {i: len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for i, r in safe.items()}
    assert {r["doc_id"]: r["length"] for r in docs.collect()} == sizes
    final = corpus_pipeline.run(spark, folder)
    assert final.columns == docs.columns and final.count() == docs.count()


def test_repeated_rows_survive_once(spark):
    rng = random.Random(15)
    one, two, three, four = (" ".join(prose(rng, 90)) for _ in range(4))
    rows = [(1, one)] * 4 + [(None, two)] * 3 + [(None, three), (5, three), (6, four), (6, "other words " + four), (7, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    single = materialize(corpus_pipeline.near_dedup(spark, docs, ""))
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.substring_dedup(spark, single, "").collect()), key=str)
    last = next(t for i, t in got if i == 6)
    assert last in (four, "other words " + four)
    assert got == sorted([(1, one), (None, two), (5, three), (6, last), (7, ""), (None, None)], key=str)


def test_texts_that_stay_do_not_move(spark):
    """Of 200 texts with two near copies only those that may be dropped are joined."""
    rng = random.Random(31)
    texts = [" ".join(prose(rng, 60)) for _ in range(200)]
    rows = [*enumerate(texts), (300, texts[3] + " end"), (301, texts[4] + " end"), (5, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for it
        kept = corpus_pipeline.near_dedup(spark, materialize(docs), "")
        assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == list(enumerate(texts))
        plan = kept._jdf.queryExecution().optimizedPlan()
        assert plan.getClass().getSimpleName() == "Union"
        stay = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan.children().head())
        assert stay.count() >= 190  # of the side without an exchange
        assert "Exchange hashpartitioning" not in stay.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_empty_tables(spark, tables, tmp_path):
    folder, _ = tables
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR)
    table = "embeddings" if "embedding" in name else "documents"
    n = duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/{table}.parquet'").fetchall()[0][0]
    if name not in ("op5_secret_scan", "op10_packing", "op12_spelling_variants"):
        assert rows.count() == n
    assert {"doc_id", "vec_id", "word"} & set(rows.columns)
    assert not rows.isEmpty() or name == "op5_secret_scan"
