"""Captured bodies: the table that stands where a live fetch would be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAPTURE_SCHEMA = "url string, status int, error string, body string"
LAST_GOOD_STATUS = 202  # a visit with a higher status is a failure


def load_captures(
    source: DataFrame,
    url: str = "url",
    body: str = "body",
    status: str | None = None,
    error: str | None = None,
) -> DataFrame:
    """Bring any table of pages (batch or streaming) to ``url, status, error, body``.

    Without a status column every row counts as answered with 200.
    """
    return source.select(
        F.col(url).alias("url"),
        (F.col(status).cast("int") if status else F.lit(200)).alias("status"),
        (F.col(error) if error else F.lit(None).cast("string")).alias("error"),
        F.col(body).alias("body"),
    )


def stream_captures(spark: SparkSession, path: str, schema, **columns) -> DataFrame:
    """The same table as a stream of newly arriving parquet files."""
    return load_captures(spark.readStream.schema(schema).parquet(path), **columns)


def visit_failed(status: Column | str = "status", error: Column | str = "error") -> Column:
    """Why a visit of the capture fails, NULL when it does not."""
    status = F.col(status) if isinstance(status, str) else status
    error = F.col(error) if isinstance(error, str) else error
    return F.coalesce(
        error,
        F.when(status.isNull(), F.lit("no_status")).when(
            status > LAST_GOOD_STATUS, F.concat(F.lit("status_"), status.cast("string"))
        ),
    )
