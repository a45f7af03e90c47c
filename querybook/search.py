"""Search over the parts as companies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dialmesh.operators.block_search import BlockIndex, search_names, search_totals
from dialmesh.operators.search import (
    name_hits,
    name_index,
    search_companies,
    search_phones,
    search_result,
    search_sort,
    tokenize_names,
)
from dialmesh.session import scratch_dir
from dialmesh.sources.company_store import CompanyStore

from .base import query, table

_TOKENS = "regexp_extract_all(lower({text}), '[\\pL\\pN_]+')"


def part_store(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "'p' || p_partkey || '.example' AS id",
        "'https://p' || p_partkey || '.example' AS domain",
        "p_name || ' & Co' AS commercial_name",
        "CASE WHEN p_size % 4 = 0 THEN '' ELSE p_brand END AS legal_name",
        "array(p_type, p_name || ' ' || p_name, 'No.' || (p_size % 10)) AS all_available_names",
        "CASE WHEN p_size % 2 = 0 THEN array('+1 541-754-' || lpad(cast(p_size as string), 4, '0'), "
        "'+1 888-999-0000') END AS phone_numbers",
    )


_BAGS = f"""
  SELECT id, field, bag FROM (
    SELECT 'p' || p_partkey || '.example' AS id, 'commercial_name' AS field,
           {_TOKENS.format(text="p_name || ' & Co'")} AS bag FROM part
    UNION ALL
    SELECT 'p' || p_partkey || '.example', 'legal_name',
           {_TOKENS.format(text="CASE WHEN p_size % 4 = 0 THEN '' ELSE p_brand END")} FROM part
    UNION ALL
    SELECT 'p' || p_partkey || '.example', 'all_available_names',
           {_TOKENS.format(text="p_type || ' ' || p_name || ' ' || p_name || ' No.' || (p_size % 10)")} FROM part
  ) WHERE len(bag) > 0
"""
_POSTINGS = f"""
  SELECT term, field, id, count(*) AS tf, any_value(len) AS len
  FROM (SELECT id, field, len(bag) AS len, unnest(bag) AS term FROM ({_BAGS}))
  GROUP BY term, field, id
"""
# One query per distinct part name, with a word of its own twice and one unknown word.
_QUERIES = """
  SELECT p_name AS query_id, p_name || ' ' || split_part(p_name, ' ', 1) || ' 7 unheard' AS name
  FROM part GROUP BY p_name
"""
_HITS = f"""
  SELECT query_id, id, round(max(score), 6) AS score FROM (
    SELECT q.query_id, p.id, p.field,
           sum(q.weight * ln(1 + (f.n - d.df + 0.5) / (d.df + 0.5)) * p.tf * 2.2
               / (p.tf + 1.2 * (0.25 + 0.75 * p.len / f.avg_len))) AS score
    FROM (SELECT query_id, term, count(*) AS weight
          FROM (SELECT query_id, unnest({_TOKENS.format(text='name')}) AS term FROM ({_QUERIES}))
          GROUP BY query_id, term) q
    JOIN ({_POSTINGS}) p ON p.term = q.term
    JOIN (SELECT term, field, count(*) AS df FROM ({_POSTINGS}) GROUP BY term, field) d
      ON d.term = p.term AND d.field = p.field
    JOIN (SELECT field, count(*) AS n, avg(len(bag)) AS avg_len FROM ({_BAGS}) GROUP BY field) f
      ON f.field = p.field
    GROUP BY q.query_id, p.id, p.field
  ) GROUP BY query_id, id
"""
_RANKED = f"""
  SELECT query_id, id, score, total, rank FROM (
    SELECT *, count(*) OVER (PARTITION BY query_id) AS total,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM ({_HITS})
  ) WHERE rank <= 10
"""


def name_queries(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return names.selectExpr(
        "p_name AS query_id", "p_name || ' ' || split_part(p_name, ' ', 1) || ' 7 unheard' AS name"
    )


@query("tokenize_names", _POSTINGS)
def tokenize_names_query(spark, sf_dir):
    return tokenize_names(part_store(spark, sf_dir))


@query("name_hits", _HITS)
def name_hits_query(spark, sf_dir):
    return name_hits(name_index(part_store(spark, sf_dir)), name_queries(spark, sf_dir))


@query("search_sort", f"SELECT query_id, id, score, rank FROM ({_RANKED})")
def search_sort_query(spark, sf_dir):
    return search_sort(name_hits_query(spark, sf_dir))


@query(
    "search_by_name",
    f"""
    SELECT r.query_id, r.total, r.rank, r.score, r.id, 'https://' || r.id AS domain,
           p_name || ' & Co' AS commercial_name
    FROM ({_RANKED}) r JOIN part ON 'p' || p_partkey || '.example' = r.id
    """,
)
def search_by_name_query(spark, sf_dir):
    store = part_store(spark, sf_dir)
    hits = name_hits(name_index(store), name_queries(spark, sf_dir))
    return search_result(hits, store).select(
        "query_id", "total", "rank", "score", "id", "domain", "commercial_name"
    )


def _block_index(spark, store):
    return BlockIndex.build(store, f"{scratch_dir(spark)}/index")


@query(
    "search_names",
    f"""
    SELECT r.query_id, r.total, r.rank, r.score, r.id, p_name || ' & Co' AS commercial_name
    FROM ({_RANKED}) r JOIN part ON 'p' || p_partkey || '.example' = r.id
    """,
)
def search_names_query(spark, sf_dir):
    """The page of each search with only the blocks scored that can reach it."""
    store = part_store(spark, sf_dir)
    found = search_names(_block_index(spark, store), store, name_queries(spark, sf_dir))
    return found.select("query_id", "total", "rank", "score", "id", "commercial_name")


@query(
    "search_kept_index",
    f"""
    SELECT r.query_id, r.total, r.rank, r.score, r.id, p_name || ' & Co' AS commercial_name
    FROM ({_RANKED}) r JOIN part ON 'p' || p_partkey || '.example' = r.id
    """,
)
def search_kept_index_query(spark, sf_dir):
    """An index built on former names, searched after an import has changed a fifth of them."""
    work = scratch_dir(spark)
    store = CompanyStore(spark, f"{work}/store", f"store_{uuid.uuid4().hex}")
    parts = part_store(spark, sf_dir)
    former = F.when(F.pmod(F.xxhash64("id"), F.lit(5)) == 0, F.concat(F.lit("Former "), "legal_name"))
    store.create(parts.withColumn("commercial_name", F.coalesce(former, "commercial_name")))
    store.index_names()
    store.upsert(parts.withColumn("n", F.lit(1)), ["n"], batch=1)
    found = store.search_names(name_queries(spark, sf_dir))
    return found.select("query_id", "total", "rank", "score", "id", "commercial_name")


@query("search_totals", f"SELECT query_id, count(*) AS total FROM ({_HITS}) GROUP BY query_id")
def search_totals_query(spark, sf_dir):
    return search_totals(_block_index(spark, part_store(spark, sf_dir)), name_queries(spark, sf_dir))


@query("search_result", f"SELECT query_id, total, rank, id FROM ({_RANKED})")
def search_result_query(spark, sf_dir):
    return search_by_name_query(spark, sf_dir).select("query_id", "total", "rank", "id")


# Numbers in several spellings, one shared by half of all companies, some invalid.
_PHONE_TEXT = """CASE s_suppkey % 4 WHEN 0 THEN '(541) 754-' || lpad(CAST(s_suppkey % 50 AS {string}), 4, '0')
                 WHEN 1 THEN '888.999.0000' WHEN 2 THEN '555-555-5555'
                 ELSE '+1 541 754 ' || lpad(CAST(s_suppkey % 50 AS {string}), 4, '0') END"""
_PHONE_HITS = f"""
  SELECT s_suppkey AS query_id, id
  FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 1 THEN '+1 888-999-0000'
               WHEN s_suppkey % 4 <> 2 THEN '+1 541-754-' || lpad((s_suppkey % 50)::VARCHAR, 4, '0') END AS n
        FROM supplier) q
  JOIN (SELECT 'p' || p_partkey || '.example' AS id,
               unnest(['+1 541-754-' || lpad(p_size::VARCHAR, 4, '0'), '+1 888-999-0000']) AS n
        FROM part WHERE p_size % 2 = 0) p ON p.n = q.n
"""


_PHONE_PAGES = f"""
    SELECT query_id, total, rank, id FROM (
      SELECT *, count(*) OVER (PARTITION BY query_id) AS total,
             row_number() OVER (PARTITION BY query_id ORDER BY id) AS rank FROM ({_PHONE_HITS})
    ) WHERE rank <= 10
"""


def phone_queries(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS query_id", f"{_PHONE_TEXT.format(string='string')} AS phone"
    )


@query("search_by_phone", _PHONE_PAGES)
def search_by_phone_query(spark, sf_dir):
    store = part_store(spark, sf_dir)
    return search_phones(store, phone_queries(spark, sf_dir)).select("query_id", "total", "rank", "id")


@query("search_stored_numbers", _PHONE_PAGES)
def search_stored_numbers_query(spark, sf_dir):
    """The same searches by the numbers that the store keeps."""
    store = CompanyStore(spark, f"{scratch_dir(spark)}/store", f"store_{uuid.uuid4().hex}")
    store.create(part_store(spark, sf_dir))
    return store.search_phones(phone_queries(spark, sf_dir)).select("query_id", "total", "rank", "id")


_MIXED = """
  SELECT s_suppkey AS query_id,
         CASE s_suppkey % 5 WHEN 0 THEN 'Co' WHEN 1 THEN '' WHEN 2 THEN 'red' WHEN 3 THEN 'unheard' END AS name,
         CASE s_suppkey % 5 WHEN 2 THEN '888-999-0000' WHEN 4 THEN
              CASE WHEN s_suppkey % 2 = 0 THEN '(888) 999 0000' ELSE '123' END END AS phone
  FROM supplier
"""


@query(
    "search_companies",
    """
    SELECT s_suppkey AS query_id,
           CASE WHEN s_suppkey % 5 IN (1, 2) THEN 'invalid_params' WHEN s_suppkey % 5 = 3 THEN 'not_found'
                WHEN s_suppkey % 5 = 4 AND s_suppkey % 2 = 1 THEN 'invalid_number' END AS error
    FROM supplier
    """,
)
def search_companies_query(spark, sf_dir):
    table(spark, sf_dir, "supplier").createOrReplaceTempView("dialmesh_suppliers")
    queries = spark.sql(_MIXED.replace("FROM supplier", "FROM dialmesh_suppliers"))
    _, status = search_companies(part_store(spark, sf_dir), queries)
    return status


@query(
    "search_companies_results",
    f"""
    SELECT query_id, total, rank, id FROM (
      SELECT *, count(*) OVER (PARTITION BY query_id) AS total,
             row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
      FROM (
        SELECT s_suppkey AS query_id, id, 1.0 AS score FROM supplier, (
          SELECT 'p' || p_partkey || '.example' AS id FROM part WHERE p_size % 2 = 0)
        WHERE s_suppkey % 5 = 4 AND s_suppkey % 2 = 0
        UNION ALL
        SELECT s_suppkey, id, round(1.0 / len(bag), 6) FROM supplier, ({_BAGS})
        WHERE s_suppkey % 5 = 0 AND field = 'commercial_name'
      )
    ) WHERE rank <= 10
    """,
)
def search_companies_results_query(spark, sf_dir):
    table(spark, sf_dir, "supplier").createOrReplaceTempView("dialmesh_suppliers")
    queries = spark.sql(_MIXED.replace("FROM supplier", "FROM dialmesh_suppliers"))
    results, _ = search_companies(part_store(spark, sf_dir), queries)
    return results.select("query_id", "total", "rank", "id")
