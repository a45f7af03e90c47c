"""Company records in, ranked search out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.companies import import_stats
from ..operators.search import NameIndex, name_index
from ..sources.company_table import CompanyTable
from ..sources.lists import read_companies


def import_companies(
    spark: SparkSession, table: CompanyTable, path: str | list[str], mode: str = "failfast"
) -> DataFrame:
    """Read company lists and upsert them; gives ``flushed, failed``."""
    records = read_companies(spark, path, mode)
    table.upsert(records.rows, ["file", "line_index"])
    good = records.rows.selectExpr("cast(null as string) as error")
    return import_stats(good.unionByName(records.rejects.select("error")))


def build_index(table: CompanyTable, path: str) -> NameIndex:
    name_index(table.read()).save(path)
    return NameIndex.load(table.spark, path)
