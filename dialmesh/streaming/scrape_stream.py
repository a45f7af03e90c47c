"""Incremental runs: pages are handled as their files arrive.

``start_store_stream`` merges each micro-batch into a company store at once; the store
knows the last batch it holds, so a batch that is run again changes nothing.
``start_scrape_stream`` keeps a log instead, to be merged at any time.

Each micro-batch extracts, validates and dedupes the numbers of its pages and writes
them to a folder of its own (overwritten on a retry, so a batch counts once).  The
log holds rows, not lists; a company's numbers are those of its latest batch, as a
partial update replaces the list.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..frames import add_once
from ..functions.urls import company_id
from ..joins import lookup_join
from ..operators.companies import UpdateResult, update_companies
from ..operators.crawl import phones_to_company
from ..operators.phones import page_phones, sanitize_phones
from ..session import releasing
from ..sources.company_store import CompanyStore

LOG_SCHEMA = "id string, number string, confidence int, url string, pos int, batch bigint"


def batch_phones(captures: DataFrame) -> DataFrame:
    """``id, number, confidence, url, pos``: a batch's valid numbers per company."""
    rows = add_once(page_phones(captures, ["url"], "body"), "id", company_id("url"))
    return sanitize_phones(rows.where("id is not null"), ["id"], ["url", "pos"])


def start_scrape_stream(
    captures: DataFrame, log_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Run ``captures`` (a stream) into the log; by default until the input is drained."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch_phones(batch).write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    return (
        captures.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_log(spark: SparkSession, log_path: str, after: int = -1) -> DataFrame:
    """The log's batches later than ``after``; no rows before the first batch.

    Batches are folders, so those applied already are not read again.
    """
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(log_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)
    return log.where(F.col("batch") > after)


def latest_phones(log: DataFrame) -> DataFrame:
    """Rows of each company's latest batch."""
    last = log.groupBy("id").agg(F.max("batch").alias("_last"))
    return lookup_join(log, last, "id").where("batch = _last").drop("_last")


def apply_log(store: DataFrame, log: DataFrame) -> UpdateResult:
    """Merge the log into a store as one partial update per company."""
    rows = latest_phones(log).select("id", F.struct("url", "pos").alias("pos"), "number")
    return update_companies(store, phones_to_company(rows, "id"))


def merge_batch(store: CompanyStore, captures: DataFrame, batch: int) -> DataFrame:
    """Merge the numbers of a batch of captures into the store; gives the rejects.

    A company with numbers in the batch has its list replaced.  A batch that the store holds
    already, or that is older than the last one it holds, changes nothing.
    """
    rows = batch_phones(captures).select("id", F.struct("url", "pos").alias("pos"), "number")
    return store.update(phones_to_company(rows, "id"), batch=batch)


def start_store_stream(
    captures: DataFrame, store: CompanyStore, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Run ``captures`` (a stream) into the store; by default until the input is drained.

    One stream per store: its batch numbers are the store's.  A batch that failed is run
    again from the checkpoint; the store is then as it was before that batch or holds it.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        with releasing():
            merge_batch(store, batch, batch_id)

    return (
        captures.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
