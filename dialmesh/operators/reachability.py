"""Which URLs answered: results, classes and counts from a log of probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..joins import lookup_join

SUCCESSFUL = "successful"
FAILED = "failed"
BAD = "bad"
NO_PROBE = "no_probe"


def check_results(urls: DataFrame, probe_log: DataFrame) -> DataFrame:
    """``idx, url, status, error`` per input URL ``(idx, url)``, duplicates included.

    ``probe_log(url, status, error)`` should hold one row per URL; of several the
    smallest (status, error) counts, which keeps the result deterministic and is
    combined before the shuffle.  The status of an error is 0.
    """
    one = probe_log.groupBy("url").agg(
        F.min(F.struct("status", "error")).alias("_probe")
    )
    # Rows without a URL get a key of their own instead of meeting on NULL.
    key = F.coalesce("url", F.concat(F.lit("#"), F.col("idx").cast("string"))).alias("_key")
    keyed, one = urls.select("*", key), one.withColumnRenamed("url", "_key")
    return lookup_join(keyed, one, "_key", "left").select(
        "idx",
        "url",
        F.when(F.col("_probe.error").isNotNull(), F.lit(0))
        .otherwise(F.coalesce("_probe.status", F.lit(0)))
        .alias("status"),
        F.when(F.col("_probe").isNull(), F.lit(NO_PROBE)).otherwise(F.col("_probe.error")).alias(
            "error"
        ),
    )


def classify_status(status: Column | str = "status", error: Column | str = "error") -> Column:
    status = F.col(status) if isinstance(status, str) else status
    error = F.col(error) if isinstance(error, str) else error
    return (
        F.when(status == 200, F.lit(SUCCESSFUL))
        .when(error.isNotNull(), F.lit(FAILED))
        .otherwise(F.lit(BAD))
    )


def reachability_summary(results: DataFrame) -> DataFrame:
    """One row: ``successful, failed, bad``."""
    kind = classify_status()
    return results.agg(*[F.count_if(kind == k).alias(k) for k in (SUCCESSFUL, FAILED, BAD)])


def bad_status_histogram(results: DataFrame) -> DataFrame:
    return (
        results.where(classify_status() == BAD)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def successful_urls(results: DataFrame) -> DataFrame:
    """URLs that answered with 200, with their input position."""
    return results.where("status = 200").select("idx", "url")
