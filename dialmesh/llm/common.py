"""Shared by the operators: whole-table maps over Arrow batches and table reading."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed and return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 2_000_000  # text handled at a time: arrays of numbers per byte are many times larger
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.sparkContext.master.startswith("local["):  # else the package is shipped with the job
        root = str(Path(__file__).parents[2])
        known = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
        if root not in known.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[list]]], schema: str
) -> DataFrame:
    """``make()`` once per task gives a function from a batch to lists of output columns."""
    names = [part.split()[0].strip("`") for part in schema.split(", ")]

    def run(batches):
        step = make()
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_arrays(columns, names)
            del batch
            release_memory()

    return df.mapInArrow(run, schema)


@lru_cache(maxsize=1)
def _malloc_trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def release_memory() -> None:
    """Give memory that is free back to the system: a worker outlives its task, and numpy's arrays
    leave holes that the C library would keep."""
    pa.default_memory_pool().release_unused()
    trim = _malloc_trim()
    if trim is not None:
        trim(0)


def slices(*columns: pa.Array, size: int = SLICE_BYTES):
    """Batches cut so that the first column, of strings, holds about ``size`` bytes."""
    sizes = np.cumsum(pc.binary_length(columns[0]).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(sizes):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + size, "right")))
        yield [c.slice(at, end - at) for c in columns]
        at = end
