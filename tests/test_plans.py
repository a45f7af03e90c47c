"""What the plans must look like, whatever the size of the data."""

import re

import pytest

from querybook import BOOK

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    return BOOK[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, columns",
    [
        ("match_phones", {"doc_id", "text", "source"}),
        ("site_phones", {"url", "html"}),
        ("nav_links", {"page_id", "html"}),
        ("company_id", {"page_id", "url"}),
        ("classify_status", {"event_id", "event_type"}),
        ("tokenize_names", {"p_partkey", "p_name", "p_brand", "p_type", "p_size"}),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert schemas and set().union(*[{c.split(":")[0] for c in s.split(",")} for s in schemas]) == columns


@pytest.mark.parametrize("name", ["match_phones", "body_text", "nav_links", "page_phones", "tokenize_names", "validate_phones"])
def test_extraction_does_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


@pytest.mark.parametrize("name", ["site_phones", "dedup_phones", "sanitize_phones", "distinct_links"])
def test_dedup_shuffles_once_after_combining(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_m" in text


def test_costly_columns_stand_in_one_place(spark):
    text = plan(spark, "sanitize_phones")
    assert text.count("find_in_set") == 1
    assert plan(spark, "update_companies").count("(?s)^(?:([A-Za-z][A-Za-z0-9+.\\-]*+):)?+") <= 5


@pytest.mark.parametrize("name", sorted(set(BOOK) - {"create_company_table", "stream_scrape_updates"}))
def test_no_plan_pairs_everything_or_leaves_the_jvm(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ArrowEvalPython"):
        assert node not in text
    # One task only takes partial results: never a sort or a window.
    for line in text.splitlines():
        assert not re.search(r"Window .*\[\], \[", line), line
