"""CSV lists of domains and of company records, with line numbers and rejects.

Files are read as splittable text.  A line's number inside its file is the count
of lines in the file's earlier splits plus its place in its own split, so the
only thing gathered is one small row per input split; no file passes through a
single task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..frames import add_once
from ..functions.text import trim_space
from ..functions.urls import parse_url_checked
from ..session import materialize

INVALID_HEADER = "invalid_header"
EMPTY_CSV = "empty_csv"
PARSE_ERROR = "parse_error"
WRONG_NUMBER_OF_FIELDS = "wrong_number_of_fields"

DOMAIN_HEADER = ["domain"]
# The column names of the company list.
COMPANY_HEADER = [
    "domain",
    "company_commercial_name",
    "company_legal_name",
    "company_all_available_names",
]
REPORT_LIMIT = 20  # rejected lines shown in a report

_QUOTED = r"\"(?:[^\"]|\"\")*+\""
_FIELD = rf"(?s),({_QUOTED}|[^\",]*+)"
_WELL_FORMED = rf"(?s)^(?:,(?:{_QUOTED}|[^\",]*+))++\z"


class ListError(ValueError):
    """Raised in ``failfast`` mode; ``lines`` holds the reported rejects."""

    def __init__(self, code: str, lines: list | None = None):
        super().__init__(code if not lines else f"{code}: {len(lines)} reported line(s)")
        self.code = code
        self.lines = lines or []


@dataclass(frozen=True)
class CsvList:
    """Good rows, rejected lines ``(file, line_index, line, error)`` and file states
    ``(file, header, error, good_rows, rejected_rows)``."""

    rows: DataFrame
    rejects: DataFrame
    files: DataFrame

    def report(self) -> DataFrame:
        """The first rejected lines, in file order."""
        return self.rejects.orderBy("file", "line_index").limit(REPORT_LIMIT)

    def failfast(self) -> CsvList:
        """Raise when a file has no good header, or any line was rejected, or
        nothing was read; return self otherwise."""
        lines = self.report().collect()  # at most REPORT_LIMIT rows
        bad_file = self.files.where("error is not null").orderBy("file").limit(1).collect()
        if bad_file and bad_file[0]["error"] != EMPTY_CSV:
            raise ListError(bad_file[0]["error"], lines)
        if lines:
            raise ListError("invalid_lines", lines)
        if bad_file:
            raise ListError(EMPTY_CSV)
        return self


def _physical_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.regexp_replace("value", r"\r$", "").alias("line"),
    )


def _with_row_id(lines: DataFrame) -> DataFrame:
    """Number the rows of each scan task and write them down.

    The id grows by one per row inside a split.  How a scan cuts files into splits
    depends on the cores at hand, so the lines are stored with their ids: every later
    use sees the same cut.
    """
    return materialize(lines.withColumn("row_id", F.monotonically_increasing_id()))


_BEFORE = (Window.unboundedPreceding, -1)
_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def _number_rows(lines: DataFrame, header_of) -> tuple[DataFrame, DataFrame]:
    """Lines ``(file, line_index, line, header)`` without the header, and one row
    ``(file, header, header_line)`` per file.  Lines carry ``file, split, line, row_id``."""
    splits = lines.groupBy("file", "split").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("row_id").alias("first_id"),
        F.min_by("line", "row_id").alias("first_line"),
    )
    in_file = Window.partitionBy("file").orderBy("split")
    # One row per input split (bytes / split size), written so that its size is known.
    offsets = materialize(
        splits.select(
            "file",
            "split",
            (
                F.coalesce(F.sum("n").over(in_file.rowsBetween(*_BEFORE)), F.lit(0))
                - F.col("first_id")
            ).alias("shift"),
            F.first("first_line").over(in_file.rowsBetween(*_WHOLE)).alias("header_line"),
            (F.row_number().over(in_file) == 1).alias("is_first"),
        ).withColumn("header", header_of(F.col("header_line")))
    )
    numbered = lines.join(offsets, ["file", "split"]).select(
        "file",
        (F.col("row_id") + F.col("shift")).cast("long").alias("line_index"),
        "line",
        "header",
    )
    headers = offsets.where("is_first").select("file", "header", "header_line")
    return numbered.where("line_index > 0"), headers


def _numbered_lines(spark: SparkSession, path: str | list[str], header_of):
    return _number_rows(_with_row_id(_physical_lines(spark, path)), header_of)


def _numbered_records(spark: SparkSession, path: str | list[str], header_of):
    """The same for CSV records: blank lines are none, a quoted field may span lines."""
    lines = _physical_lines(spark, path)
    quotes = F.length(F.regexp_replace("line", '[^"]', ""))
    if lines.where(quotes % 2 == 1).isEmpty():  # then every line is a record
        return _number_rows(_with_row_id(lines.where("line <> ''")), header_of)
    return _number_joined(_join_lines(_with_row_id(lines)), header_of)


def _number_joined(records: DataFrame, header_of) -> tuple[DataFrame, DataFrame]:
    headers = records.where("line_index = 0").select(
        "file", header_of(F.col("line")).alias("header"), F.col("line").alias("header_line")
    )
    headers = materialize(headers)  # one row per file
    rows = records.where("line_index > 0").join(headers.drop("header_line"), "file")
    return rows, headers


def _state_before(start: int, window) -> tuple[Column, Column]:
    """Running count of swaps, and the state (0 outside quotes, 1 inside) before a row whose predecessors map state 0
    to ``f0`` and state 1 to ``f1``, when the partition starts in ``start``.

    A row sets the state (f0 = f1), keeps it, or swaps it.  So the state is what the
    last setting row left, swapped once per swapping row since.
    """
    swap = ((F.col("f0") == 1) & (F.col("f1") == 0)).cast("int")
    swaps_with = F.sum(swap).over(window.rowsBetween(Window.unboundedPreceding, 0))
    swaps_before = F.coalesce(F.sum(swap).over(window.rowsBetween(*_BEFORE)), F.lit(0))
    anchored = F.when(F.col("f0") == F.col("f1"), (F.col("f0") + F.col("swaps")) % 2)
    anchor = F.last(anchored, ignorenulls=True).over(window.rowsBetween(*_BEFORE))
    return swaps_with, (F.coalesce(anchor, F.lit(start)) + swaps_before) % 2


def _join_lines(lines: DataFrame) -> DataFrame:
    """Records ``(file, line_index, line)`` of lines that may lie inside quotes.

    Sorting and running sums stay inside one input split; what crosses splits is one
    row per split.  A record that is never closed keeps its first line only, which is
    then rejected as badly quoted, and the lines after it are records of their own.
    """
    led = F.concat(F.lit(","), F.col("line"))
    fields = rf"(?:,(?:{_QUOTED}|[^\",]*+)(?=,|\z))*+"
    rest = r"(?:[^\"]|\"\")*+"
    opened = rf"(?s)^{fields},\"{rest}\z"
    closed_inside = rf"(?s)^{rest}\"{fields}\z"
    reopened = rf"(?s)^{rest}\"{fields},\"{rest}\z"
    steps = lines.withColumns(
        {
            "f0": (~led.rlike(_WELL_FORMED) & led.rlike(opened)).cast("int"),
            "f1": (
                ~F.col("line").rlike(closed_inside)
                & (F.col("line").rlike(rf"(?s)^{rest}\z") | F.col("line").rlike(reopened))
            ).cast("int"),
        }
    )
    in_split = Window.partitionBy("file", "split").orderBy("row_id")
    swaps, _ = _state_before(0, in_split)
    steps = steps.withColumn("swaps", swaps)
    steps = steps.withColumns({f"b{s}": _state_before(s, in_split)[1] for s in (0, 1)})
    after = {s: F.when(F.col(f"b{s}") == 0, F.col("f0")).otherwise(F.col("f1")) for s in (0, 1)}
    splits = steps.groupBy("file", "split").agg(
        F.max_by(after[0], "row_id").alias("f0"), F.max_by(after[1], "row_id").alias("f1")
    )
    in_file = Window.partitionBy("file").orderBy("split")
    splits = splits.withColumn("swaps", _state_before(0, in_file)[0])
    splits = splits.withColumn("entry", _state_before(0, in_file)[1])
    entries = materialize(splits.select("file", "split", "entry"))
    inside = F.when(F.col("entry") == 0, F.col("b0")).otherwise(F.col("b1"))
    begins = (F.col("inside") == 0) & (F.col("line") != "")
    stated = materialize(
        steps.join(entries, ["file", "split"])
        .withColumn("inside", inside)
        .withColumn(
            "ends", F.when(F.col("inside") == 0, F.col("f0")).otherwise(F.col("f1"))
        )
        .where((F.col("inside") == 1) | (F.col("line") != ""))
        .withColumn("in_split", F.sum(begins.cast("int")).over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
        .select("file", "split", "row_id", "line", "inside", "ends", "in_split")
    )
    counts = stated.groupBy("file", "split").agg(
        F.max("in_split").alias("n"), F.max_by("ends", "row_id").alias("ends")
    )
    earlier = materialize(
        counts.select(
            "file",
            "split",
            F.coalesce(F.sum("n").over(in_file.rowsBetween(*_BEFORE)), F.lit(0)).alias("earlier"),
            F.sum("n").over(in_file.rowsBetween(*_WHOLE)).alias("all"),
            (F.last("ends").over(in_file.rowsBetween(*_WHOLE)) == 1).alias("never_closed"),
        )
    )
    # A record that is never closed ends with its first line; those after it are records.
    index = F.col("earlier") + F.col("in_split") - 1
    tail = F.col("never_closed") & (index == F.col("all") - 1) & (F.col("inside") == 1)
    marked = (
        stated.join(earlier, ["file", "split"])
        .withColumn("tail", tail)
        .where(~F.col("tail") | (F.col("line") != ""))
        .withColumn("begins", (begins | F.col("tail")).cast("int"))
        .withColumn("in_split", F.sum("begins").over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
        .select("file", "split", "row_id", "line", "in_split")
    )
    marked = materialize(marked)
    counts = marked.groupBy("file", "split").agg(F.max("in_split").alias("n"))
    before = F.coalesce(F.sum("n").over(in_file.rowsBetween(*_BEFORE)), F.lit(0))
    earlier = materialize(counts.select("file", "split", before.alias("earlier")))
    parts = marked.join(earlier, ["file", "split"]).withColumn("line_index", index.cast("long"))
    return parts.groupBy("file", "line_index").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("row_id", "line"))), lambda p: p["line"]
            ),
            "\n",
        ).alias("line")
    )


def _file_names(spark: SparkSession, path: str | list[str]) -> DataFrame:
    names = spark.read.text(path).inputFiles()
    listed = spark.createDataFrame([(n,) for n in names], "file string")
    return listed.select(F.regexp_replace("file", "^file:///", "file:/").alias("file"))


def header_check(header: Column, expected: list[str]) -> Column:
    """``invalid_header`` unless the header holds exactly the expected names, in any order."""
    same = F.array_sort(header) == F.array_sort(F.array(*[F.lit(n) for n in expected]))
    return F.when(F.coalesce(same, F.lit(False)), F.lit(None).cast("string")).otherwise(
        F.lit(INVALID_HEADER)
    )


def _file_states(
    spark: SparkSession, path: str | list[str], headers: DataFrame, checked: DataFrame, expected
) -> DataFrame:
    # File names only; empty files have no split, so no scan would report them.
    listing = _file_names(spark, path)
    counts = checked.groupBy("file").agg(
        F.count_if(F.col("error").isNull()).alias("good_rows"),
        F.count_if(F.col("error").isNotNull()).alias("rejected_rows"),
        F.count_if(F.col("error") == PARSE_ERROR).alias("badly_quoted"),
    )
    joined = listing.join(headers, "file", "left").join(counts, "file", "left")
    good = F.coalesce("good_rows", F.lit(0))
    bad = F.coalesce("rejected_rows", F.lit(0))
    return joined.select(
        "file",
        "header",
        # A file without a first line is empty, not wrong; rejects hide emptiness.
        F.when(F.col("header_line").isNull(), F.lit(EMPTY_CSV))
        .when(F.col("header").isNull(), F.lit(PARSE_ERROR))
        .when(header_check(F.col("header"), expected).isNotNull(), F.lit(INVALID_HEADER))
        .when(F.col("badly_quoted") > 0, F.lit(PARSE_ERROR))
        .when((good == 0) & (bad == 0), F.lit(EMPTY_CSV))
        .alias("error"),
        good.alias("good_rows"),
        bad.alias("rejected_rows"),
    )


def read_domains(spark: SparkSession, path: str | list[str], mode: str = "permissive") -> CsvList:
    """One-column list with the header ``domain``.

    Lines are trimmed, blank ones skipped (they still count); the index is 0-based
    with the header as 0.  Rows: ``file, line_index, url, scheme, host, hostname``.
    """
    numbered, headers = _numbered_lines(spark, path, lambda line: F.array(trim_space(line)))
    checked = (
        numbered.where(header_check(F.col("header"), DOMAIN_HEADER).isNull())
        .withColumn("line", trim_space("line"))
        .where("line <> ''")
        .transform(add_once, "parsed", parse_url_checked("line"))
        .select("file", "line_index", "line", "parsed.*")
    )
    return _finish(
        CsvList(
            rows=checked.where("error is null").drop("line", "error"),
            rejects=checked.where("error is not null").select(
                "file", "line_index", "line", "error"
            ),
            files=_file_states(spark, path, headers, checked, DOMAIN_HEADER),
        ),
        mode,
    )


def csv_fields(line: Column) -> Column:
    """Fields of one CSV record with RFC 4180 quoting; NULL when badly quoted."""
    led = F.concat(F.lit(","), line)
    fields = F.transform(
        F.regexp_extract_all(led, F.lit(_FIELD), F.lit(1)),
        lambda f: F.when(
            f.startswith('"'),
            F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )
    return F.when(led.rlike(_WELL_FORMED), fields)


def split_names(cell: Column) -> Column:
    """Names of a cell, separated by ``|`` and trimmed; an empty cell gives ``[""]``."""
    return F.transform(F.split(cell, r"\|"), trim_space)


def read_companies(spark: SparkSession, path: str | list[str], mode: str = "permissive") -> CsvList:
    """Company records: four columns in any order, RFC 4180 quoting.

    The index counts records; blank lines are none.  A badly quoted record is
    rejected with ``parse_error``, which is then the state of its file too; every line after
    it is still read.  Rows: ``file, line_index, id, domain,
    commercial_name, legal_name, all_available_names``.
    """
    numbered, headers = _numbered_records(spark, path, csv_fields)
    valid = numbered.where(header_check(F.col("header"), COMPANY_HEADER).isNull())
    fields = add_once(valid, "fields", csv_fields(F.col("line")))

    def cell(name: str) -> Column:
        place = F.array_position("header", F.lit(name)).cast("int")
        return F.get("fields", place - 1)

    right_size = F.size("fields") == len(COMPANY_HEADER)
    parsed = add_once(fields, "parsed", F.when(right_size, parse_url_checked(cell("domain"))))
    checked = parsed.select(
        "file",
        "line_index",
        F.when(F.col("fields").isNull(), F.col("line"))
        .when(~right_size, F.array_join("fields", ","))
        .otherwise(trim_space(cell("domain")))
        .alias("line"),
        F.col("parsed.hostname").alias("id"),
        F.col("parsed.url").alias("domain"),
        trim_space(cell("company_commercial_name")).alias("commercial_name"),
        trim_space(cell("company_legal_name")).alias("legal_name"),
        split_names(cell("company_all_available_names")).alias("all_available_names"),
        F.when(F.col("fields").isNull(), F.lit(PARSE_ERROR))
        .when(~right_size, F.lit(WRONG_NUMBER_OF_FIELDS))
        .otherwise(F.col("parsed.error"))
        .alias("error"),
    )
    return _finish(
        CsvList(
            rows=checked.where("error is null").drop("line", "error"),
            rejects=checked.where("error is not null").select(
                "file", "line_index", "line", "error"
            ),
            files=_file_states(spark, path, headers, checked, COMPANY_HEADER),
        ),
        mode,
    )


def _finish(result: CsvList, mode: str) -> CsvList:
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    return result.failfast() if mode == "failfast" else result
