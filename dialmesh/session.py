"""Where intermediate tables live.

Long loops cut their lineage by writing a table and reading it back.  The folder
is the one the cluster names in ``spark.checkpoint.dir``; a local session without
that setting (tests) gets a folder of its own.  What is made inside ``releasing`` is
deleted when that ends.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


MAX_BUCKETS = 100_000  # Spark's own limit
_LOCAL = threading.local()  # what the open ``releasing`` blocks of this thread have to undo


def scratch_dir(spark: SparkSession) -> str:
    """A new, not yet existing folder below the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dialmesh-"))
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/dialmesh-{uuid.uuid4().hex}"
    _at_release(lambda: remove_folder(spark, path))
    return path


def _at_release(undo: Callable[[], object]) -> None:
    blocks = getattr(_LOCAL, "blocks", [])
    if blocks:
        blocks[-1].append(undo)


@contextmanager
def releasing() -> Iterator[None]:
    """Delete the scratch folders and tables made inside, once the block is left.

    DataFrames that read them must have been written by then, to a folder named by
    ``scratch_dir`` before the block (or in an outer one).
    """
    if not hasattr(_LOCAL, "blocks"):
        _LOCAL.blocks = []
    _LOCAL.blocks.append([])
    try:
        yield
    finally:
        for undo in reversed(_LOCAL.blocks.pop()):
            undo()


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can write; nothing if it is not there."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, at = _file_system(spark, path)
    found = files.listStatus(at) if files.exists(at) else []
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and read it back: a cut in the lineage that
    survives the loss of executors and gives the planner true sizes."""
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class BucketedTable:
    """A scratch table bucketed by one key, for repeated joins on that key.

    Only the other side of each join is shuffled.  Drop it after the last join.
    """

    def __init__(self, df: DataFrame, key: str):
        self._spark = df.sparkSession
        self._name = f"dialmesh_{uuid.uuid4().hex}"
        partitions = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(partitions, MAX_BUCKETS)
        (
            df.write.format("parquet")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", scratch_dir(self._spark))
            .saveAsTable(self._name)
        )
        _at_release(self.drop)

    @property
    def df(self) -> DataFrame:
        return self._spark.table(self._name)

    def drop(self) -> None:
        self._spark.sql(f"DROP TABLE IF EXISTS {self._name}")


def is_small(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows; stops counting beyond it."""
    return df.limit(limit + 1).count() <= limit
