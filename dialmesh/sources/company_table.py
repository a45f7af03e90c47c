"""The persisted company table.

An external parquet table whose versions are whole folders: a change is written to
a new folder and the catalog entry is then pointed at it, so readers see the old
or the new version and a failed write changes nothing.  Versions are bucketed and
sorted by id, so a join with an import or an update shuffles only the smaller side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.companies import (
    STORE_COLUMNS,
    STORE_SCHEMA,
    UpdateResult,
    update_companies,
    update_fields,
    upsert_companies,
)
from ..session import materialize

INVALID_INDEX = "invalid_index"
DEFAULT_NAME = "companies"


class ConcurrentWrite(RuntimeError):
    """Another writer has switched the table to a newer version."""


class CompanyTable:
    def __init__(
        self,
        spark: SparkSession,
        location: str,
        name: str = DEFAULT_NAME,
        buckets: int | None = None,
    ):
        self.spark = spark
        self.location = location.rstrip("/")
        self.name = name
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def create(self, name: str) -> DataFrame:
        """Create the empty table; only the configured name is accepted."""
        if name != self.name:
            raise ValueError(f"{INVALID_INDEX}: only {self.name} is supported")
        self.spark.sql(
            f"CREATE TABLE {self.name} ({STORE_SCHEMA}) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self._new_folder()}'"
        )
        return self.read()

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def version(self) -> str:
        """Folder of the version that readers see."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        return described.where("col_name = 'Location'").first()["data_type"]

    def replace(self, companies: DataFrame, made_from: str | None = None) -> None:
        """Write the next version and switch to it.

        With ``made_from`` (the version that ``companies`` was made from) the switch fails
        with ``ConcurrentWrite`` when another writer has switched in between.
        """
        folder = self._new_folder()
        staged = f"{self.name}_{uuid.uuid4().hex}"
        rows = companies.select(*STORE_COLUMNS)
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            # Rows come in another cut than the buckets': one task per bucket, else
            # every task would write a file for each.
            rows = rows.repartition(self.buckets, "id")
        (
            rows.write.format("parquet")
            .bucketBy(self.buckets, "id")
            .sortBy("id")
            .option("path", folder)
            .saveAsTable(staged)
        )
        if made_from is not None and self.version() != made_from:
            self.spark.sql(f"DROP TABLE {staged}")
            raise ConcurrentWrite(f"{self.name} has a newer version than {made_from}")
        self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{folder}'")
        self.spark.sql(f"DROP TABLE {staged}")  # external: its files stay

    def upsert(self, companies: DataFrame, order: list[str]) -> None:
        made_from = self.version()
        self.replace(upsert_companies(self.read(), companies, order), made_from)

    def update(self, updates: DataFrame, order: str | None = None) -> DataFrame:
        """Partial updates ``(url, <fields>)``; gives the rejects."""
        made_from = self.version()
        return self._apply(update_companies(self.read(), materialize(updates), order), made_from)

    def update_fields(self, changes: DataFrame, order: str) -> DataFrame:
        made_from = self.version()
        return self._apply(update_fields(self.read(), materialize(changes), order), made_from)

    def _apply(self, result: UpdateResult, made_from: str) -> DataFrame:
        rejects = materialize(result.rejects)  # against the version being replaced
        self.replace(result.store, made_from)
        return rejects

    def _new_folder(self) -> str:
        return f"{self.location}/version-{uuid.uuid4().hex}"
