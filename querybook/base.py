"""Registry of queries: a Spark callable and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


BOOK: dict[str, Query] = {}


def query(name: str, sql: str | None = None, lists: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir)`` under ``name``.

    ``lists`` names array columns; both sides show them as text, because list values
    compare differently from client to client.
    """

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir).withColumns({c: F.array_join(c, " | ") for c in lists})

        texts = ", ".join(
            f"CASE WHEN {c} IS NOT NULL THEN coalesce(array_to_string({c}, ' | '), '') END AS {c}"
            for c in lists
        )
        text_sql = f"SELECT * REPLACE ({texts}) FROM ({sql})" if lists and sql else sql
        BOOK[name] = Query(run if lists else fn, text_sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
