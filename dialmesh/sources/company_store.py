"""The company store in hash partitions: a change rewrites only the partitions it touches.

Rows lie in ``parts`` partitions by the hash of their id, each a folder of its own.  A
version is a small table, one row per partition that names the folder, and the number of
the last batch that is in it.  A change writes the partitions with changed ids to new
folders, then the next version, and then points the catalog's table at it: readers see the
old or the new version, never a half, and a failed write leaves the old one as it was.
(Overwriting partition folders in place would drop the old one before the new one is there.)

A batch number makes a change count once: one that is not above the number in the version
has been applied and is skipped.

Beside the companies lie their phone numbers as ``number, id``, partitioned by number.  A
change takes the pairs that went out of, and those that came into their partitions, and the
same version switches both, so a search by number never sees one without the other.

A search index of the names is kept up in the same way: a change adds the names that went
and came in its partitions to the version, a search applies them, and ``index_names``
merges them into a new index.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.phones import validate_phone
from ..functions.urls import company_id, parse_url_checked
from ..joins import lookup_join
from ..operators.companies import (
    STORE_COLUMNS,
    STORE_SCHEMA,
    UpdateResult,
    as_store_rows,
    update_companies,
    update_fields,
    upsert_companies,
)
from ..operators.block_search import BlockIndex, NameChanges, best_hits, search_totals
from ..operators.search import NAME_FIELDS, PAGE_SIZE, asked_numbers, number_hits, ranked_page
from ..session import child_folders, materialize, remove_folder, scratch_dir
from .company_table import ConcurrentWrite

VERSION_SCHEMA = "kind string, part int, folder string, batch bigint"
COMPANIES, NUMBERS, INDEX, NAMES, BATCH = "companies", "numbers", "index", "names", "batch"
SCHEMAS = {COMPANIES: STORE_SCHEMA, NUMBERS: "number string, id string"}
NAMES_SCHEMA = "id string, commercial_name string, legal_name string, all_available_names array<string>, by int"
SPREAD = 16  # partitions that the companies with one number are dealt over
PUSHED = 200  # numbers that are named in the filter of a read
REJECT_SCHEMA = "url string, error string"


@dataclass(frozen=True)
class Version:
    at: str  # its folder
    folders: dict[int, str]  # of the partitions with companies
    numbers: dict[int, str]  # of the partitions with phone numbers
    batch: int | None  # the last one applied
    index: str | None = None  # folder of the search index
    names: tuple[str, ...] = ()  # folders of the names that changed since it was built

    def has(self, batch: int | None) -> bool:
        return batch is not None and self.batch is not None and batch <= self.batch


class CompanyStore:
    """``parts`` is fixed when the store is created; the driver handles one row per partition."""

    def __init__(self, spark: SparkSession, location: str, name: str, parts: int | None = None):
        self.spark = spark
        self.location = location.rstrip("/")
        self.name = name
        self.parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def create(self, companies: DataFrame | None = None) -> None:
        """Create the store, empty or with ``companies`` in store shape, ids once each."""
        empty = self._write_version({}, {}, None)
        self.spark.sql(f"CREATE TABLE {self.name} ({VERSION_SCHEMA}) USING parquet LOCATION '{empty}'")
        if companies is not None:
            rows = self._here(as_store_rows(companies).where("id is not null"))
            self._replace(rows, self.version(), None, self._parts_of(rows.select("id")))

    def version(self) -> Version:
        """The version that readers see."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        at = described.where("col_name = 'Location'").first()["data_type"]
        rows = self.spark.read.schema(VERSION_SCHEMA).parquet(at).collect()
        kinds = {kind: {r["part"]: r["folder"] for r in rows if r["kind"] == kind} for kind in (*SCHEMAS, INDEX, NAMES)}
        batch = max((r["batch"] for r in rows if r["batch"] is not None), default=None)
        names = tuple(folder for _, folder in sorted(kinds[NAMES].items()))
        return Version(at, kinds[COMPANIES], kinds[NUMBERS], batch, kinds[INDEX].get(0), names)

    def read(self, parts: set[int] | None = None, version: Version | None = None) -> DataFrame:
        """The rows (of some partitions), as of now: later changes do not show in them."""
        return self._read(COMPANIES, (version or self.version()).folders, parts)

    def read_numbers(self, numbers: DataFrame | None = None, version: Version | None = None) -> DataFrame:
        """``number, id``, of all companies or from the partitions of the given ``number``s."""
        folders = (version or self.version()).numbers
        if numbers is None:
            return self._read(NUMBERS, folders, None)
        placed = numbers.select("number", F.explode(self._number_parts(F.col("number"))).alias("part"))
        listed = self._read(NUMBERS, folders, {r[0] for r in placed.select("part").distinct().collect()})
        few = numbers.select("number").distinct().limit(PUSHED + 1).collect()
        if len(few) <= PUSHED:  # the filter reaches the files, which are sorted by number
            return listed.where(F.col("number").isin([r[0] for r in few]))
        return listed

    def search_phones(self, queries: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
        """``operators.search.search_phones`` by the stored numbers: reads their partitions, and
        those of the companies that are returned."""
        now = self.version()
        asked = materialize(asked_numbers(queries))
        hits = number_hits(self.read_numbers(asked, now), asked)
        found = materialize(ranked_page(hits, page_size))
        ids = found.select("id").distinct()
        companies = self.read(self._parts_of(ids), now).select(*STORE_COLUMNS)
        rows = materialize(companies.join(found, "id")).withColumnRenamed("query_id", "number")
        return lookup_join(asked, rows, "number").select("query_id", "total", "rank", "score", *STORE_COLUMNS)

    def search_phone(self, phone: str) -> DataFrame:
        """The companies with one number, by rank; ``ValueError`` if it does not validate."""
        queries = self.spark.createDataFrame([(0, phone)], "query_id int, phone string")
        error = queries.select(validate_phone("phone")["error"].alias("error")).first()["error"]
        if error:
            raise ValueError(error)
        return self.search_phones(queries).drop("query_id").orderBy("rank")

    def index_names(self) -> None:
        """Build the search index of the names, or merge what has changed since into a new one.

        Readers go on with the old one meanwhile; a change in between wins, and this fails
        with ``ConcurrentWrite``.
        """
        now = self.version()
        index = self._folder("index")
        BlockIndex.build(self.read(version=now), index)
        self._switch(self._write_version(now.folders, now.numbers, now.batch, index), now)

    def search_names(self, queries: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
        """``operators.block_search.search_names`` by the stored index and the changes since.

        ``ValueError`` if the store has no index yet.
        """
        now = self.version()
        if now.index is None:
            raise ValueError(f"{self.name} has no index of names: call index_names first")
        index, changes = BlockIndex.load(self.spark, now.index), None
        if now.names:
            changes = NameChanges.load(self.spark.read.schema(NAMES_SCHEMA).parquet(*now.names))
        page = best_hits(index, queries, page_size, changes).join(search_totals(index, queries, changes), "query_id")
        page = materialize(page)
        companies = self.read(self._parts_of(page.select("id").distinct()), now).select(*STORE_COLUMNS)
        return companies.join(page, "id").select("query_id", "total", "rank", "score", *STORE_COLUMNS)

    def get(self, url: str) -> DataFrame:
        """The row of a URL or bare domain, read from its partition only; ``ValueError`` if bad."""
        asked = self.spark.createDataFrame([(url,)], "url string").select(parse_url_checked("url").alias("p"))
        key = asked.select("p.error", "p.hostname", self._part(F.col("p.hostname")).alias("part")).first()
        if key["error"]:
            raise ValueError(key["error"])
        return self.read({key["part"]}).where(F.col("id") == key["hostname"])

    def upsert(self, companies: DataFrame, order: list[str], batch: int | None = None) -> bool:
        """Whole-record upsert, the last row per id by ``order``; False if the batch is in already."""
        now = self.version()
        if now.has(batch):
            return False
        rows = self._here(companies)
        touched = self._parts_of(as_store_rows(rows).select("id").where("id is not null"))
        self._replace(upsert_companies(self.read(touched, now), rows, order), now, batch, touched)
        return True

    def update(self, updates: DataFrame, order: str | None = None, batch: int | None = None) -> DataFrame:
        """Partial updates ``(url, <fields>)``; gives the rejects, none for a batch that is in already."""
        return self._update(updates, lambda store, rows: update_companies(store, rows, order), batch)

    def update_fields(self, changes: DataFrame, order: str, batch: int | None = None) -> DataFrame:
        """Single-field updates ``(url, field, value_json, <order>)``; gives the rejects."""
        return self._update(changes, lambda store, rows: update_fields(store, rows, order), batch)

    def remove_old(self) -> int:
        """Delete the folders that the present version does not use; gives their number.

        Not while a reader still works on an older version.
        """
        now = self.version()
        used = {"/".join(f.split("/")[-2:]) for f in [*now.folders.values(), *now.numbers.values(), *now.names]}
        used |= {"/".join(f.split("/")[-2:]) for f in (now.at, now.index) if f}
        old = [f"version/{name}" for name in child_folders(self.spark, f"{self.location}/version")]
        old += [f"index/{name}" for name in child_folders(self.spark, f"{self.location}/index")]
        for write in child_folders(self.spark, f"{self.location}/data"):
            old += [f"data/{write}/{part}" for part in child_folders(self.spark, f"{self.location}/data/{write}")]
        old = [folder for folder in old if folder.removeprefix("data/") not in used]
        for folder in old:
            remove_folder(self.spark, f"{self.location}/{folder}")
        return len(old)

    def _update(self, changes: DataFrame, merge, batch: int | None) -> DataFrame:
        now = self.version()
        if now.has(batch):
            return self.spark.createDataFrame([], REJECT_SCHEMA)
        rows = self._here(changes)
        ids = rows.select(company_id("url").alias("id")).where("id is not null").distinct()
        asked = self.read(self._parts_of(ids), now)
        rejects = materialize(merge(asked, rows).rejects)
        # partitions without any of the ids stay as they are
        touched = self._parts_of(asked.select("id").join(ids, "id", "left_semi"))
        result: UpdateResult = merge(self.read(touched, now), rows)
        self._replace(result.store, now, batch, touched)
        return rejects

    def _here(self, rows: DataFrame) -> DataFrame:
        """``rows`` written once and read in the session of this store (a stream has its own)."""
        path = scratch_dir(self.spark)
        return self.spark.read.schema(materialize(rows, path).schema).parquet(path)

    def _part(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def _number_parts(self, number: Column) -> Column:
        """Partitions that may hold a number: a hot one lies in several, by id."""
        first = F.xxhash64(number)
        return F.array_distinct(F.array(*[F.pmod(F.pmod(first, F.lit(self.parts)) + i, F.lit(self.parts)).cast("int") for i in range(SPREAD)]))

    def _number_part(self, number: Column, key: Column) -> Column:
        place = F.pmod(F.xxhash64(number), F.lit(self.parts)) + F.pmod(F.xxhash64(key), F.lit(SPREAD))
        return F.pmod(place, F.lit(self.parts)).cast("int")

    def _parts_of(self, ids: DataFrame) -> set[int]:
        return {r[0] for r in ids.select(self._part(F.col("id"))).distinct().collect()}

    def _read(self, kind: str, folders: dict[int, str], parts: set[int] | None) -> DataFrame:
        asked = [folder for part, folder in sorted(folders.items()) if parts is None or part in parts]
        if not asked:
            return self.spark.createDataFrame([], SCHEMAS[kind])
        return self.spark.read.schema(SCHEMAS[kind]).parquet(*asked)

    def _write(self, rows: DataFrame, parts: set[int], order: list[str]) -> dict[int, str]:
        """Folders of partitions, from rows with their ``part``."""
        written = self._folder("data")
        placed = rows.repartition(len(parts), "part").sortWithinPartitions("part", *order)
        placed.write.partitionBy("part").parquet(written)
        made = child_folders(self.spark, written)
        return {int(name.removeprefix("part=")): f"{written}/{name}" for name in made if name.startswith("part=")}

    def _replace(self, rows: DataFrame, made_from: Version, batch: int | None, parts: set[int]) -> None:
        """The next version: ``rows`` in the given partitions, the others as they were."""
        folders, numbers, names = dict(made_from.folders), made_from.numbers, made_from.names
        if parts:
            placed = rows.select(*STORE_COLUMNS, self._part(F.col("id")).alias("part"))
            folders.update(self._write(placed, parts, ["id"]))
            before, after = self._read(COMPANIES, made_from.folders, parts), self._read(COMPANIES, folders, parts)
            numbers = self._changed_numbers(_listed(before), _listed(after), numbers)
            if made_from.index:
                names = (*names, *self._changed_names(before, after))
        last = made_from.batch if batch is None else batch
        self._switch(self._write_version(folders, numbers, last, made_from.index, names), made_from)

    def _switch(self, version: str, made_from: Version) -> None:
        if self.version().at != made_from.at:
            raise ConcurrentWrite(f"{self.name} has a newer version than {made_from.at}")
        self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{version}'")

    def _changed_numbers(self, before: DataFrame, after: DataFrame, folders: dict[int, str]) -> dict[int, str]:
        """Folders of the number partitions after companies changed from one state to another."""
        pair = ["number", "id"]
        sides = before.select(*pair, F.lit(-1).alias("by")).unionByName(after.select(*pair, F.lit(1).alias("by")))
        changed = materialize(sides.groupBy(*pair).agg(F.sum("by").alias("by")).where("by <> 0"))
        part = self._number_part(F.col("number"), F.col("id")).alias("part")
        touched = {r[0] for r in changed.select(part).distinct().collect()}
        if not touched:
            return folders
        kept = self._read(NUMBERS, folders, touched).join(changed.where("by < 0").select(*pair), pair, "left_anti")
        made = self._write(kept.unionByName(changed.where("by > 0").select(*pair)).select(*pair, part), touched, pair)
        return {p: f for p, f in folders.items() if p not in touched} | made

    def _changed_names(self, before: DataFrame, after: DataFrame) -> list[str]:
        """The folder of the names that changed, if any did."""
        folder = f"{self._folder('data')}/names"
        changed = materialize(NameChanges.between(before, after).select("id", *NAME_FIELDS, "by"), folder)
        return [] if changed.isEmpty() else [folder]

    def _write_version(
        self,
        folders: dict[int, str],
        numbers: dict[int, str],
        batch: int | None,
        index: str | None = None,
        names: tuple[str, ...] = (),
    ) -> str:
        rows = [(COMPANIES, part, folder, None) for part, folder in folders.items()]
        rows += [(NUMBERS, part, folder, None) for part, folder in numbers.items()]
        rows += [(NAMES, at, folder, None) for at, folder in enumerate(names)]
        rows += [(INDEX, 0, index, None)] if index else []
        path = self._folder("version")
        self.spark.createDataFrame([*rows, (BATCH, None, None, batch)], VERSION_SCHEMA).coalesce(1).write.parquet(path)
        return path

    def _folder(self, kind: str) -> str:
        return f"{self.location}/{kind}/{uuid.uuid4().hex}"


def _listed(companies: DataFrame) -> DataFrame:
    return companies.select("id", F.explode(F.array_distinct("phone_numbers")).alias("number"))
