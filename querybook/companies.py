"""Lists of companies and domains, the company store, lookups and updates.

List files are written by Spark from the given tables into the scratch folder and
then read back by the operators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dialmesh.functions.phones import validate_phone
from dialmesh.operators.companies import (
    get_companies,
    import_stats,
    update_companies,
    update_fields,
    upsert_companies,
)
from dialmesh.plans.directory import import_companies
from dialmesh.session import scratch_dir
from dialmesh.sources.company_json import company_json, parse_company_json, read_company_json
from dialmesh.sources.company_store import CompanyStore
from dialmesh.sources.company_table import CompanyTable
from dialmesh.sources.lists import read_companies, read_domains

from .base import query, table

# --- lists -------------------------------------------------------------------
_DOMAIN_LINE = """
  CASE page_id % 10
    WHEN 3 THEN 'bad host ' || page_id
    WHEN 5 THEN 'site' || page_id || '.example'
    WHEN 7 THEN 'ftp://site' || page_id || '.example'
    ELSE url
  END
"""
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"


def _write_lines(df, header: bool = True) -> str:
    path = scratch_dir(df.sparkSession)
    df.write.option("header", header).option("escape", '"').option("emptyValue", "").csv(path)
    return path


def domain_list(spark, sf_dir):
    lines = table(spark, sf_dir, "pages").selectExpr(f"{_DOMAIN_LINE} AS domain")
    return read_domains(spark, _write_lines(lines))


@query(
    "read_domains",
    f"""
    WITH u AS (SELECT CASE WHEN contains(l, '://') THEN l ELSE 'https://' || l END AS url
               FROM (SELECT {_DOMAIN_LINE} AS l FROM pages)
               WHERE l NOT LIKE 'bad%' AND l NOT LIKE 'ftp%')
    SELECT url, regexp_extract(url, '^([a-z]+)', 1) AS scheme, {_HOST} AS host, {_HOST} AS hostname FROM u
    """,
)
def read_domains_query(spark, sf_dir):
    return domain_list(spark, sf_dir).rows.select("url", "scheme", "host", "hostname")


@query(
    "csv_rejects",
    f"""
    SELECT l AS line, CASE WHEN l LIKE 'bad%' THEN 'invalid_url' ELSE 'invalid_scheme' END AS error
    FROM (SELECT {_DOMAIN_LINE} AS l FROM pages) WHERE l LIKE 'bad%' OR l LIKE 'ftp%'
    """,
)
def csv_rejects_query(spark, sf_dir):
    return domain_list(spark, sf_dir).rejects.select("line", "error")


@query(
    "header_check",
    """
    SELECT 'c_name' AS header, 'invalid_header' AS error, 0 AS good_rows, 0 AS rejected_rows
    UNION ALL
    SELECT 'domain', NULL, (SELECT count(*) FROM supplier), 0
    UNION ALL
    SELECT 's_name', 'invalid_header', 0, 0
    """,
)
def header_check_query(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    good = suppliers.selectExpr("'s' || s_suppkey || '.example' AS domain")
    other = table(spark, sf_dir, "customer").select("c_name")
    paths = [_write_lines(df) for df in (good, other, suppliers.select("s_name"))]
    files = read_domains(spark, paths).files
    return files.groupBy(F.get("header", F.lit(0)).alias("header"), "error").agg(
        F.sum("good_rows").alias("good_rows"), F.sum("rejected_rows").alias("rejected_rows")
    )


@query(
    "empty_input_check",
    """
    SELECT 'good' AS list, NULL AS error, count(*) AS good_rows, 0 AS rejected_rows FROM supplier
    UNION ALL SELECT 'bad', NULL, 0, count(*) FROM region
    UNION ALL SELECT 'blank', 'empty_csv', 0, 0
    """,
)
def empty_input_check_query(spark, sf_dir):
    """A list is empty without good lines, unless lines were rejected."""
    domains = {
        "good": ("supplier", "'s' || s_suppkey || '.example'"),
        "bad": ("region", "'bad region ' || r_regionkey"),
        "blank": ("nation", "CASE WHEN n_nationkey < 0 THEN 'x' ELSE '' END"),
    }
    states = []
    for name, (source, line) in domains.items():
        lines = table(spark, sf_dir, source).selectExpr(f"{line} AS domain")
        files = read_domains(spark, _write_lines(lines)).files
        states.append(
            files.agg(
                F.min("error").alias("error"),
                F.sum("good_rows").alias("good_rows"),
                F.sum("rejected_rows").alias("rejected_rows"),
            ).withColumn("list", F.lit(name))
        )
    return states[0].unionByName(states[1]).unionByName(states[2])


# The cells hold commas, quotes and blanks; some domains are bad.
_CUSTOMER_CELLS = [
    "CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name || ' INC.' END AS company_legal_name",
    "CASE WHEN c_custkey % 13 = 5 THEN 'no domain ' || c_custkey "
    "ELSE ' c' || c_custkey || '.example:80' END AS domain",
    "c_name || ' |' || c_mktsegment || ' |  x' AS company_all_available_names",
    "' ' || c_name || ', \"' || c_mktsegment || '\" ' AS company_commercial_name",
]


def company_list(spark, sf_dir):
    cells = table(spark, sf_dir, "customer").selectExpr(*_CUSTOMER_CELLS)
    return read_companies(spark, _write_lines(cells))


@query(
    "read_companies",
    """
    SELECT 'c' || c_custkey || '.example' AS id, 'https://c' || c_custkey || '.example:80' AS domain,
           c_name || ', "' || c_mktsegment || '"' AS commercial_name,
           CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name || ' INC.' END AS legal_name,
           [c_name, c_mktsegment, 'x'] AS all_available_names
    FROM customer WHERE c_custkey % 13 <> 5
    """,
    lists=("all_available_names",),
)
def read_companies_query(spark, sf_dir):
    return company_list(spark, sf_dir).rows.drop("file", "line_index")


@query(
    "import_stats",
    """
    SELECT count(*) FILTER (c_custkey % 13 <> 5) AS flushed,
           count(*) FILTER (c_custkey % 13 = 5) AS failed FROM customer
    """,
)
def import_stats_query(spark, sf_dir):
    records = company_list(spark, sf_dir)
    good = records.rows.selectExpr("cast(null as string) as error")
    return import_stats(good.unionByName(records.rejects.select("error")))


# --- line numbers, rejects and file states ------------------------------------
# Lists of two hundred customers each, in key order, so their number grows with the table.
# Every fifth has a badly quoted header, the first opens a quote that is never closed, and
# one more list has no lines.
_HEADER_LINE = "domain,company_commercial_name,company_legal_name,company_all_available_names"
_BAD_HEADER = 'domain,"company'
_CUSTOMERS, _PAGES = 200, 50  # lines of a list
_EMPTY_LIST = 99_999_999
_COMPANY_LINE = f"""
  CASE WHEN c_custkey = 2 THEN 'h2.example,"open,,x'
       WHEN c_custkey % 7 = 0 THEN 'h' || c_custkey || '.example,three,fields'
       WHEN c_custkey % 7 = 1 THEN 'bad url ' || c_custkey || ',N,,x'
       WHEN c_custkey % 7 = 2 AND c_custkey >= {_CUSTOMERS} THEN 'h' || c_custkey || '.example,a"b,,x'
       WHEN c_custkey % 7 = 3 THEN ''
       ELSE 'h' || c_custkey || '.example,N' || c_custkey || ',,x | y' END
"""
_COMPANY_LINES = f"SELECT c_custkey, c_custkey // {_CUSTOMERS} AS list, {_COMPANY_LINE} AS line FROM customer"
_COMPANY_RECORDS = f"""
  SELECT *, CASE WHEN c_custkey = 2 THEN 'parse_error' WHEN c_custkey % 7 = 0 THEN 'wrong_number_of_fields'
                 WHEN c_custkey % 7 = 1 THEN 'invalid_url'
                 WHEN c_custkey % 7 = 2 AND c_custkey >= {_CUSTOMERS} THEN 'parse_error' END AS error,
         row_number() OVER (PARTITION BY list ORDER BY c_custkey) AS line_index
  FROM ({_COMPANY_LINES}) WHERE line <> '' AND list % 5 <> 4
"""


def _write_lists(lines, headers) -> str:
    """Path of one file per list: ``lines(list, k, line)`` in the order of k below the header
    that ``headers(list, line)`` has for it."""
    rows = lines.unionByName(headers.selectExpr("list", "-1L AS k", "line"))
    rows = rows.selectExpr("lpad(list, 8, '0') AS list", "k", "line")
    path = scratch_dir(lines.sparkSession)
    rows.repartition("list").sortWithinPartitions("list", "k").select("list", "line").write.partitionBy("list").text(path)
    return f"{path}/*"


def _numbered(df):
    return df.withColumn("list", F.regexp_extract("file", "list=([0-9]+)", 1).cast("long"))


def numbered_companies(spark, sf_dir):
    lines = table(spark, sf_dir, "customer").selectExpr(
        f"c_custkey div {_CUSTOMERS} AS list", "cast(c_custkey AS long) AS k", f"{_COMPANY_LINE} AS line"
    )
    headers = lines.select("list").distinct().selectExpr(
        "list", f"CASE WHEN list % 5 = 4 THEN '{_BAD_HEADER}' ELSE '{_HEADER_LINE}' END AS line"
    )
    empty = spark.createDataFrame([(_EMPTY_LIST, _HEADER_LINE)], "list long, line string")
    return read_companies(spark, _write_lists(lines, headers.unionByName(empty)))


@query(
    "company_line_numbers",
    f"SELECT list, line_index, 'h' || c_custkey || '.example' AS id FROM ({_COMPANY_RECORDS}) WHERE error IS NULL",
)
def company_line_numbers_query(spark, sf_dir):
    return _numbered(numbered_companies(spark, sf_dir).rows).select("list", "line_index", "id")


@query(
    "company_rejects",
    f"""
    SELECT list, line_index, CASE error WHEN 'invalid_url' THEN split_part(line, ',', 1) ELSE line END AS line, error
    FROM ({_COMPANY_RECORDS}) WHERE error IS NOT NULL
    """,
)
def company_rejects_query(spark, sf_dir):
    return _numbered(numbered_companies(spark, sf_dir).rejects).select("list", "line_index", "line", "error")


@query(
    "company_file_states",
    f"""
    SELECT l.list, CASE WHEN l.list % 5 = 4 OR count(*) FILTER (r.error = 'parse_error') > 0 THEN 'parse_error'
                        WHEN count(r.list) = 0 THEN 'empty_csv' END AS error,
           count(*) FILTER (r.list IS NOT NULL AND r.error IS NULL) AS good_rows,
           count(*) FILTER (r.error IS NOT NULL) AS rejected_rows
    FROM (SELECT DISTINCT list FROM ({_COMPANY_LINES})) l LEFT JOIN ({_COMPANY_RECORDS}) r ON r.list = l.list GROUP BY l.list
    UNION ALL SELECT {_EMPTY_LIST}, 'empty_csv', 0, 0
    """,
)
def company_file_states_query(spark, sf_dir):
    return _numbered(numbered_companies(spark, sf_dir).files).select("list", "error", "good_rows", "rejected_rows")


_DOMAIN_ROWS = f"""
  SELECT page_id // {_PAGES} AS list, row_number() OVER (PARTITION BY page_id // {_PAGES} ORDER BY page_id) AS line_index,
         CASE WHEN page_id % 9 = 4 THEN '' ELSE {_DOMAIN_LINE} END AS line FROM pages
"""


def numbered_domains(spark, sf_dir):
    lines = table(spark, sf_dir, "pages").selectExpr(
        f"page_id div {_PAGES} AS list", "cast(page_id AS long) AS k",
        f"CASE WHEN page_id % 9 = 4 THEN '' ELSE {_DOMAIN_LINE} END AS line",
    )
    headers = lines.select("list").distinct().selectExpr("list", "'domain' AS line")
    return read_domains(spark, _write_lists(lines, headers))


@query(
    "domain_line_numbers",
    f"""
    SELECT list, line_index, line LIKE 'bad%' OR line LIKE 'ftp%' AS rejected FROM ({_DOMAIN_ROWS}) WHERE line <> ''
    """,
)
def domain_line_numbers_query(spark, sf_dir):
    result = numbered_domains(spark, sf_dir)
    rows = result.rows.select("file", "line_index", F.lit(False).alias("rejected")).unionByName(
        result.rejects.select("file", "line_index", F.lit(True).alias("rejected"))
    )
    return _numbered(rows).select("list", "line_index", "rejected")


@query(
    "domain_reject_report",
    f"""
    SELECT list, line_index, line FROM ({_DOMAIN_ROWS}) WHERE line LIKE 'bad%' OR line LIKE 'ftp%'
    ORDER BY list, line_index LIMIT 20
    """,
)
def domain_reject_report_query(spark, sf_dir):
    return _numbered(numbered_domains(spark, sf_dir).report()).select("list", "line_index", "line")


# --- store -------------------------------------------------------------------
_STORE_COLUMNS = """
  'c' || c_custkey || '.example' AS id, 'https://c' || c_custkey || '.example' AS domain,
  c_name AS commercial_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name || ' INC.' END AS legal_name
"""
_NUMBER = "'+1 541-754-' || lpad(CAST(c_custkey % 500 AS {string}), 4, '0')"
_SQL_NUMBER = _NUMBER.format(string="VARCHAR")
_SQL_STORE = f"""
  SELECT {_STORE_COLUMNS}, [c_name, c_mktsegment] AS all_available_names,
         CASE WHEN c_custkey % 4 = 1 THEN [{_SQL_NUMBER}] END AS phone_numbers
  FROM customer
"""


def customer_store(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "'c' || c_custkey || '.example' AS id",
        "'https://c' || c_custkey || '.example' AS domain",
        "c_name AS commercial_name",
        "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name || ' INC.' END AS legal_name",
        "array(c_name, c_mktsegment) AS all_available_names",
        f"CASE WHEN c_custkey % 4 = 1 THEN array({_NUMBER.format(string='string')}) END AS phone_numbers",
    )


# Imported rows: several per key, and keys the store does not know.
_IMPORT_KEY = "o_custkey + CASE WHEN o_orderkey % 50 = 0 THEN 1000000 ELSE 0 END"


@query(
    "upsert_companies",
    f"""
    WITH imported AS (
      SELECT {_IMPORT_KEY} AS k, max(o_orderkey) AS o FROM orders GROUP BY 1
    ), fresh AS (
      SELECT 'c' || k || '.example' AS id, 'https://c' || k || '.example' AS domain,
             'Order ' || o AS commercial_name, '' AS legal_name, [] ::VARCHAR[] AS all_available_names,
             NULL::VARCHAR[] AS phone_numbers
      FROM imported
    )
    SELECT * FROM ({_SQL_STORE}) WHERE id NOT IN (SELECT id FROM fresh)
    UNION ALL SELECT * FROM fresh
    """,
    lists=("all_available_names", "phone_numbers"),
)
def upsert_companies_query(spark, sf_dir):
    return upsert_companies(
        customer_store(spark, sf_dir), _imported_orders(spark, sf_dir), ["o_orderkey"]
    )


def _imported_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"'https://c' || ({_IMPORT_KEY}) || '.example' AS domain",
        "'Order ' || o_orderkey AS commercial_name",
        "'' AS legal_name",
        "cast(array() as array<string>) AS all_available_names",
    )


@query(
    "create_company_table",
    """
    SELECT 's' || s_suppkey || '.example' AS id, 'https://s' || s_suppkey || '.example' AS domain,
           s_name AS commercial_name, '' AS legal_name, [s_name, 'Nation ' || s_nationkey] AS all_available_names,
           CASE WHEN s_suppkey % 2 = 1 THEN ['+1 541-754-3010'] END AS phone_numbers
    FROM supplier
    """,
    lists=("all_available_names", "phone_numbers"),
)
def create_company_table_query(spark, sf_dir):
    """Create, import a list file, import it again, then merge phone numbers."""
    companies = CompanyTable(spark, scratch_dir(spark), f"companies_{uuid.uuid4().hex}")
    companies.create(companies.name)
    suppliers = table(spark, sf_dir, "supplier")
    path = _write_lines(
        suppliers.selectExpr(
            "'s' || s_suppkey || '.example' AS domain",
            "s_name AS company_commercial_name",
            "'' AS company_legal_name",
            "s_name || '|Nation ' || s_nationkey AS company_all_available_names",
        )
    )
    import_companies(spark, companies, path)
    numbers = suppliers.selectExpr(
        "'https://s' || (s_suppkey * 2 + 1) || '.example/contact' AS url",
        "array('+1 541-754-3010') AS phone_numbers",
    )
    companies.update(numbers)
    return companies.read()


_JSON_SQL = """
    SELECT s_suppkey,
      '{"domain":"https://s' || s_suppkey || '.example","commercial_name":"' || s_name
      || '","legal_name":"","all_available_names":["' || s_name || '","\\"N' || s_nationkey
      || '\\""],"id":"s' || s_suppkey || '.example"'
      || CASE WHEN s_suppkey % 3 = 0 THEN ',"phone_numbers":["+1 541-754-3010"]' ELSE '' END || '}' AS document
    FROM supplier
"""


def _suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey",
        "'https://s' || s_suppkey || '.example' AS domain",
        "s_name AS commercial_name",
        "'' AS legal_name",
        "array(s_name, '\"N' || s_nationkey || '\"') AS all_available_names",
        "'s' || s_suppkey || '.example' AS id",
        "CASE WHEN s_suppkey % 3 = 0 THEN array('+1 541-754-3010') "
        "WHEN s_suppkey % 3 = 1 THEN cast(array() as array<string>) END AS phone_numbers",
    )


@query("company_json", _JSON_SQL)
def company_json_query(spark, sf_dir):
    return _suppliers(spark, sf_dir).select("s_suppkey", company_json().alias("document"))


@query(
    "parse_company_json",
    """
    SELECT s_suppkey, 's' || s_suppkey || '.example' AS id, s_name AS commercial_name, '' AS legal_name,
           [s_name, '"N' || s_nationkey || '"'] AS all_available_names,
           CASE WHEN s_suppkey % 3 = 0 THEN ['+1 541-754-3010'] END AS phone_numbers
    FROM supplier
    """,
    lists=("all_available_names", "phone_numbers"),
)
def parse_company_json_query(spark, sf_dir):
    documents = company_json_query(spark, sf_dir)
    return documents.select("s_suppkey", parse_company_json("document").alias("c")).select(
        "s_suppkey", "c.id", "c.commercial_name", "c.legal_name", "c.all_available_names", "c.phone_numbers"
    )


@query(
    "read_company_json",
    """
    SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 's' || s_suppkey || '.example' END AS id,
           CASE s_suppkey % 4 WHEN 1 THEN 'parse_error' WHEN 2 THEN 'invalid_url' WHEN 3 THEN 'missing_host' END AS error
    FROM supplier
    """,
)
def read_company_json_query(spark, sf_dir):
    """Broken documents, bad and missing domains beside good ones."""
    documents = company_json_query(spark, sf_dir).withColumn(
        "document",
        F.expr("""CASE s_suppkey % 4 WHEN 0 THEN document WHEN 1 THEN substr(document, 1, length(document) - 3)
                  WHEN 2 THEN '{"domain":"http://a b"}' ELSE '{"commercial_name":"x"}' END"""),
    )
    return documents.select("s_suppkey", read_company_json("document").alias("c")).select(
        "s_suppkey", F.col("c.company.id").alias("id"), "c.error"
    )


# --- lookup and updates ------------------------------------------------------
_LOOKUP = """
  CASE o_orderkey % 5 WHEN 0 THEN 'c' || o_custkey || '.example'
                      WHEN 1 THEN 'http://c' || o_custkey || '.example:81/about'
                      WHEN 2 THEN 'c' || (o_custkey + 1000000) || '.example'
                      WHEN 3 THEN 'bad host' || o_custkey
                      ELSE ' https://c' || o_custkey || '.example ' END
"""


@query(
    "get_company",
    f"""
    WITH keys AS (
      SELECT o_orderkey, {_LOOKUP} AS url,
             CASE WHEN o_orderkey % 5 = 2 THEN o_custkey + 1000000
                  WHEN o_orderkey % 5 <> 3 THEN o_custkey END AS k
      FROM orders
    )
    SELECT url, CASE WHEN k IS NOT NULL THEN 'c' || k || '.example' END AS id,
           commercial_name, legal_name, all_available_names, phone_numbers, domain,
           CASE WHEN k IS NULL THEN 'invalid_url' WHEN s.id IS NULL THEN 'not_found' END AS error
    FROM keys LEFT JOIN ({_SQL_STORE}) s ON s.id = 'c' || k || '.example'
    """,
    lists=("all_available_names", "phone_numbers"),
)
def get_company_query(spark, sf_dir):
    urls = table(spark, sf_dir, "orders").selectExpr(f"{_LOOKUP} AS url")
    return get_companies(customer_store(spark, sf_dir), urls)


_FIELD = """CASE o_orderkey % 6 WHEN 0 THEN 'legal_name' WHEN 1 THEN 'phone_numbers'
            WHEN 2 THEN 'commercial_name' WHEN 3 THEN 'colour' WHEN 4 THEN 'domain'
            ELSE 'all_available_names' END"""
_VALUE = """CASE o_orderkey % 6 WHEN 0 THEN '"Legal ' || o_orderkey || '"'
            WHEN 1 THEN '["+1 541-754-' || o_orderkey || '", "x"]' WHEN 2 THEN 'null'
            WHEN 3 THEN '"red"' WHEN 4 THEN CAST(o_orderkey AS {string}) ELSE '[]' END"""
_CHANGED_KEY = "o_custkey + CASE WHEN o_orderkey % 70 = 0 THEN 1000000 ELSE 0 END"


def _changes(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        f"'c' || ({_CHANGED_KEY}) || '.example' AS url",
        f"{_FIELD} AS field",
        f"{_VALUE.format(string='string')} AS value_json",
        "o_orderkey",
    )


_LAST = f"""
  SELECT 'c' || {_CHANGED_KEY} || '.example' AS id,
         max(o_orderkey) FILTER (o_orderkey % 6 = 0) AS legal,
         max(o_orderkey) FILTER (o_orderkey % 6 = 1) AS phone,
         max(o_orderkey) FILTER (o_orderkey % 6 = 2) AS commercial,
         max(o_orderkey) FILTER (o_orderkey % 6 = 5) AS names
  FROM orders GROUP BY 1
"""


@query(
    "update_field",
    f"""
    SELECT s.id, s.domain, CASE WHEN l.commercial IS NULL THEN s.commercial_name END AS commercial_name,
           CASE WHEN l.legal IS NULL THEN s.legal_name ELSE 'Legal ' || l.legal END AS legal_name,
           CASE WHEN l.names IS NULL THEN s.all_available_names ELSE [] END AS all_available_names,
           CASE WHEN l.phone IS NULL THEN s.phone_numbers
                ELSE ['+1 541-754-' || l.phone, 'x'] END AS phone_numbers
    FROM ({_SQL_STORE}) s LEFT JOIN ({_LAST}) l ON l.id = s.id
    """,
    lists=("all_available_names", "phone_numbers"),
)
def update_field_query(spark, sf_dir):
    return update_fields(customer_store(spark, sf_dir), _changes(spark, sf_dir), "o_orderkey").store


@query(
    "update_field_rejects",
    f"""
    SELECT url, error, count(*) AS n FROM (
      SELECT 'c' || {_CHANGED_KEY} || '.example' AS url,
             CASE WHEN o_orderkey % 6 IN (3, 4) THEN 'invalid_params'
                  WHEN o_orderkey % 70 = 0 THEN 'not_found' END AS error
      FROM orders)
    WHERE error IS NOT NULL GROUP BY url, error
    """,
)
def update_field_rejects_query(spark, sf_dir):
    result = update_fields(customer_store(spark, sf_dir), _changes(spark, sf_dir), "o_orderkey")
    return result.rejects.groupBy("url", "error").agg(F.count(F.lit(1)).alias("n"))


_UPDATED_STORE = f"""
    WITH l AS (
      SELECT 'c' || o_custkey || '.example' AS id, max(o_orderkey) AS phone,
             max(o_orderkey) FILTER (o_orderkey % 4 = 0) AS legal
      FROM orders GROUP BY 1
    )
    SELECT s.id, s.domain, s.commercial_name,
           CASE WHEN l.legal IS NULL THEN s.legal_name ELSE 'L' || l.legal END AS legal_name,
           s.all_available_names,
           CASE WHEN l.phone IS NULL THEN s.phone_numbers ELSE ['n' || l.phone] END AS phone_numbers
    FROM ({_SQL_STORE}) s LEFT JOIN l ON l.id = s.id
"""


def _order_updates(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "'https://c' || o_custkey || '.example' AS url",
        "array('n' || o_orderkey) AS phone_numbers",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'L' || o_orderkey END AS legal_name",
        "o_orderkey",
    )


@query("update_companies", _UPDATED_STORE, lists=("all_available_names", "phone_numbers"))
def update_companies_query(spark, sf_dir):
    updates = _order_updates(spark, sf_dir)
    return update_companies(customer_store(spark, sf_dir), updates, "o_orderkey").store


def _stored(spark, companies):
    store = CompanyStore(spark, f"{scratch_dir(spark)}/store", f"store_{uuid.uuid4().hex}")
    store.create(companies)
    return store


@query("update_store", _UPDATED_STORE, lists=("all_available_names", "phone_numbers"))
def update_store_query(spark, sf_dir):
    """``update_companies`` on the partitioned store: two changes, of which the older is repeated."""
    store = _stored(spark, customer_store(spark, sf_dir))
    updates = _order_updates(spark, sf_dir)
    store.update(updates.drop("legal_name"), "o_orderkey", batch=1)
    store.update(updates.drop("phone_numbers"), "o_orderkey", batch=2)
    store.update(updates.selectExpr("url", "'again' AS legal_name"), batch=1)
    return store.read()


@query(
    "company_phone_check",
    f"""
    SELECT id, p AS number, p AS valid_number
    FROM (SELECT id, unnest(phone_numbers) AS p FROM ({_SQL_STORE}))
    UNION ALL
    SELECT 'c' || c_custkey || '.example', n.number, n.valid_number FROM customer, (VALUES
      ('555-555-5555', NULL), ('635 271 8110', NULL), ('(826) 754-3010', '+1 826-754-3010'),
      ('582.754.3010', '+1 582-754-3010'), ('+1 (327) 754-3010', '+1 327-754-3010'),
      ('541-754-3010;ext=12', '+1 541-754-3010 ext. 12'), ('(541) 754-3010 x7', '+1 541-754-3010 ext. 7'),
      ('541-754-3010 ext. 405', '+1 541-754-3010 ext. 405'), ('ext. 12', NULL)) n(number, valid_number)
    """,
)
def company_phone_check_query(spark, sf_dir):
    """Stored numbers of each company, and for each the same other spellings, good and bad."""
    others = [
        "555-555-5555", "635 271 8110", "(826) 754-3010", "582.754.3010", "+1 (327) 754-3010",
        "541-754-3010;ext=12", "(541) 754-3010 x7", "541-754-3010 ext. 405", "ext. 12",
    ]
    stored = customer_store(spark, sf_dir).select("id", F.explode("phone_numbers").alias("number"))
    spelled = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(".example")).alias("id"),
        F.explode(F.array(*map(F.lit, others))).alias("number"),
    )
    return stored.unionByName(spelled).withColumn("valid_number", validate_phone("number")["number"])
