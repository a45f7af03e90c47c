import math
import random
import re
from collections import Counter

import pytest

from dialmesh.operators import search as ops
from dialmesh.operators.companies import STORE_SCHEMA

FIELDS = ["commercial_name", "legal_name", "all_available_names"]
WORDS = ["glass", "auto", "bay", "tea", "on", "the", "Café", "x_1", "42"]


def make_store(seed=1, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        def words(low):
            return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, 5)))

        phones = [f"+1 541-754-{rng.randint(0, 9):04d}" for _ in range(rng.randint(0, 3))] or None
        rows.append((f"c{i:02d}.example", f"https://c{i:02d}.example", words(1) + " & Co.", words(0),
                     [words(0) for _ in range(rng.randint(0, 3))], phones))
    return rows


def tokens(text):
    return re.findall(r"\w+", text.lower())


def bm25(rows, query):
    bags = {f: {r[0]: tokens(r[2 + k] if k < 2 else "\n".join(r[4])) for r in rows} for k, f in enumerate(FIELDS)}
    best = {}
    for field in FIELDS:
        docs = {i: b for i, b in bags[field].items() if b}
        mean = sum(map(len, docs.values())) / len(docs)
        for i, bag in docs.items():
            score = 0.0
            for term, weight in Counter(tokens(query)).items():
                df = sum(term in b for b in docs.values())
                tf = bag.count(term)
                if tf:
                    idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                    score += weight * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / mean))
            if score:
                best[i] = max(best.get(i, 0), score)
    return sorted(((round(s, 6), i) for i, s in best.items()), key=lambda p: (-p[0], p[1]))


@pytest.fixture(scope="module")
def rows():
    return make_store()


@pytest.fixture
def store(spark, rows):
    return spark.createDataFrame(rows, STORE_SCHEMA)


QUERIES = ["glass", "Bay, AUTO!", "tea tea the", "café 42 unknown", "x_1", "nothing here"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_ranking_against_plain_bm25(spark, store, rows, broadcast, monkeypatch):
    """Both ways of joining queries with postings give the same, whole result."""
    if not broadcast:
        monkeypatch.setattr(ops, "BROADCAST_TERMS", 0)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, name string")
    hits = ops.name_hits(ops.name_index(store), queries).cache()
    got = {q: [] for q in range(len(QUERIES))}
    for r in hits.collect():
        got[r["query_id"]].append((r["score"], r["id"]))
    for q, text in enumerate(QUERIES):
        want = bm25(rows, text)
        assert sorted(i for _, i in got[q]) == sorted(i for _, i in want), text
        assert dict((i, s) for s, i in got[q]) == pytest.approx(dict((i, s) for s, i in want), abs=2e-6)
    results = ops.search_result(hits, store).orderBy("query_id", "rank").collect()
    for q, text in enumerate(QUERIES):
        want = bm25(rows, text)
        mine = [r for r in results if r["query_id"] == q]
        assert [r["id"] for r in mine] == [i for _, i in want[:10]]
        assert all(r["total"] == len(want) for r in mine)
    hits.unpersist()


def test_saved_index(spark, store, rows, tmp_path):
    ops.name_index(store).save(str(tmp_path))
    index = ops.NameIndex.load(spark, str(tmp_path))
    got = [r["id"] for r in ops.search_by_name(store, "glass on", index).collect()]
    assert got == [i for _, i in bm25(rows, "glass on")[:10]]


def test_two_companies_share_a_word(spark):
    rows = [("a.example", "https://a.example", "Bay Auto Glass", "", ["Bay Auto Glass"], ["+1 415-626-4400"]),
            ("b.example", "https://b.example", "Look through our Glass", "", ["Look through our Glass"], None),
            ("c.example", "https://c.example", "Tea House", "", ["Tea House"], None)]
    store = spark.createDataFrame(rows, STORE_SCHEMA)
    out = ops.search_company(store, name="glass").collect()
    assert [(r["rank"], r["id"], r["total"]) for r in out] == [(1, "a.example", 2), (2, "b.example", 2)]
    assert [r["id"] for r in ops.search_company(store, phone="(415) 626 4400").collect()] == ["a.example"]
    assert ops.search_company(store, name="unheard").isEmpty()
    for name, phone in (("", ""), ("a", "b")):
        with pytest.raises(ValueError, match="invalid_params"):
            ops.search_company(store, name, phone)
    with pytest.raises(ValueError, match="invalid_number"):
        ops.search_company(store, phone="12")


def test_batch_dispatch(spark, store, rows):
    asked = [(1, "glass", None), (2, "glass", ""), (3, None, "541.754.0003"), (4, "", "+1 (541) 754-0003"),
             (5, "a", "541-754-0003"), (6, None, None), (7, "unheard", None), (8, "", "555-555-5555"),
             (9, None, "541-754-9999"), (10, "+1 541-754-0003", None)]
    queries = spark.createDataFrame(asked, "query_id int, name string, phone string")
    results, status = ops.search_companies(store, queries)
    assert {r["query_id"]: r["error"] for r in status.collect()} == {
        1: None, 2: None, 3: None, 4: None, 5: "invalid_params", 6: "invalid_params", 7: "not_found",
        8: "invalid_number", 9: "not_found", 10: "not_found"}
    got = {q: [] for q, _, _ in asked}
    for r in results.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], r["total"]))
    glass = bm25(rows, "glass")
    assert got[1] == got[2] == [(i, len(glass)) for _, i in glass[:10]]
    phone = sorted(r[0] for r in rows if r[5] and "+1 541-754-0003" in r[5])
    assert got[3] == got[4] == [(i, len(phone)) for i in phone[:10]]


def test_each_hit_is_shuffled_once(spark, store):
    """Totals and top hits share one aggregation of the postings."""
    queries = spark.createDataFrame([(0, "glass")], "query_id int, name string")
    hits = ops.name_hits(ops.name_index(store), queries)
    result = ops.search_result(hits, store)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "CartesianProduct" not in plan and "WindowGroupLimit" in plan


def test_many_scores_are_dealt_by_company(spark, store, rows, monkeypatch):
    """A store in one partition does not add up all scores in one task."""
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, name string")
    index = ops.name_index(store.coalesce(1))
    monkeypatch.setattr(ops, "TASK_PARTS", 40)
    hits = ops.name_hits(index, queries)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = [int(k) for k in re.findall(r"hashpartitioning\(id#\d+, (\d+)\)", plan)]
    assert dealt and n <= dealt[0] <= ops.MAX_DEALT
    assert plan.index("HashAggregate") < plan.index("BroadcastHashJoin") < plan.index("hashpartitioning(id#")
    got = hits.collect()
    for q, text in enumerate(QUERIES):
        want = {i: s for s, i in bm25(rows, text)}
        assert {r["id"]: r["score"] for r in got if r["query_id"] == q} == pytest.approx(want, abs=2e-6)
    assert len(got) == len({(r["query_id"], r["id"]) for r in got})


def test_words_of_names(column):
    from dialmesh.functions.names import name_tokens

    cases = {
        "Joe's Diner": ["joe's", "diner"], "3.5 and 1,000": ["3.5", "and", "1,000"], "हिन्दी भाषा": ["हिन्दी", "भाषा"],
        "Cafe\u0301 O’Neil": ["cafe\u0301", "o’neil"], "東京 tower": ["東", "京", "tower"], "a-b_c & d.": ["a", "b_c", "d"],
        "example.com": ["example.com"], "": [], "'...'": [],
    }
    assert column(list(cases), name_tokens) == list(cases.values())


def test_counts_of_many_words(column):
    from dialmesh.functions.names import name_tokens, term_counts

    words = [f"w{i % 4000}" for i in range(16_000)]
    (out,) = column([" ".join(words)], lambda c: term_counts(name_tokens(c)))
    assert {r["term"]: r["tf"] for r in out} == Counter(words) and len(out) == 4000
    assert column(["", "b a b"], lambda c: term_counts(name_tokens(c))) == [[], [("a", 1), ("b", 2)]]
