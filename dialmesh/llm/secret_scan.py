"""Secret scanning: candidate strings, judged by a random forest on how and where they stand.

A candidate is a run of twelve or more of the characters of keys, addresses and paths with a
digit in it, or any value that is quoted or assigned after a credential word.  Its features are its length, the changes between kinds of characters, how much
of it dictionary words cover, whether it is part of a path, and the words beside it.  The
forest learns from labelled findings (Spark's own implementation) and is turned into one SQL
expression, so scanning and redaction are column expressions without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import add_once
from ..session import materialize

CHARS = "A-Za-z0-9_+/.@-"
CANDIDATE = rf"(?<![{CHARS}])[A-Za-z_+/.@-]*+[0-9][{CHARS}]*+(?:={{1,2}}(?![{CHARS}]))?+"
LEAST = 12
BESIDE = 40  # characters kept on either side
CREDENTIAL = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api_?key|auth|credential|private|access_?key)"
_INSIDE = "|".join(rf"{q}[^{q}\r\n]++(?:(?<=\\){q}[^{q}\r\n]*+){{0,200}}+{q}" for q in "\"'`")
#: Up to a value: a credential word, its quote or bracket, and a mark or the quote of the value.
#: Group 1 is the value, which is only looked at: a credential word in it counts too.
ASSIGNED = (
    rf"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|auth|credential|private|access_?key)[A-Za-z0-9_-]*+"
    rf"[\"'`\]]*+[ \t]*+(?:(?::=|==|=>|[=:])[ \t]*+(?=({_INSIDE}|[\"'`]?+[^\s\"'`]\S*+))|(?=[\"'`])(?=({_INSIDE})))"
)
TEST_PATH = r"(?i)(test|example|sample|mock|fixture|demo)"
DICTIONARY = 400  # most frequent words beside candidates
PART_ROWS = 20_000  # labelled findings of one label in a partition
TREES, DEPTH = 20, 6
N_FEATURES = 14
MASK = "[SECRET]"

Tree = float | tuple  # share of secrets, or (feature, threshold, tree up to it, tree beyond)


@dataclass
class Forest:
    trees: list[Tree]
    dictionary: list[str] = field(default_factory=list)


def _starts(gaps: Column, taken: Column) -> Column:
    """Places, from 1, of the matches ``taken`` of a pattern that splits a text into ``gaps``."""
    none = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("starts"))
    sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(taken)), taken, lambda g, t: F.struct(F.length(g).alias("gap"), F.length(t).alias("own")))

    def add(a, x):
        start = a["at"] + x["gap"]
        return F.struct((start + x["own"]).alias("at"), F.array_append(a["starts"], start).alias("starts"))

    return F.aggregate(sizes, none, add, lambda a: a["starts"])


def candidates(text: str) -> Column:
    """Candidates of the column ``text``, one for each place: ``value, start`` (from 1),
    ``before, after``."""
    t = F.col(text)

    def place(value, start):
        first = F.greatest(start - BESIDE, F.lit(1))
        return F.struct(
            value.alias("value"),
            start.alias("start"),
            F.substr(t, first, start - first).alias("before"),
            F.substr(t, start + F.length(value), F.lit(BESIDE)).alias("after"),
        )

    def assigned(raw, start):
        quoted = raw.rlike("(?s)^([\"'`]).*\\1$") & (F.length(raw) > 1)
        bare = F.regexp_replace(F.regexp_replace(raw, "^[\"'`]", ""), r"[\"'`,;.)\]}>]+$", "")
        value = F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(bare)
        return place(value, start + raw.rlike("^[\"'`]").cast("int"))

    matches = lambda pattern, group: F.regexp_extract_all(t, F.lit(pattern), F.lit(group))
    runs, heads = matches(CANDIDATE, 0), matches(ASSIGNED, 0)
    free = F.zip_with(runs, _starts(F.split(t, CANDIDATE, -1), runs), lambda x, s: place(F.regexp_replace(x, r"[.@/-]+$", ""), s))
    free = F.filter(free, lambda c: (F.length(c["value"]) >= LEAST) & c["value"].rlike("[0-9]"))
    raw = F.zip_with(matches(ASSIGNED, 1), matches(ASSIGNED, 2), lambda x, y: F.concat(x, y))
    starts = F.zip_with(_starts(F.split(t, ASSIGNED, -1), heads), heads, lambda s, h: s + F.length(h))
    kept = F.filter(F.zip_with(raw, starts, assigned), lambda c: F.length(c["value"]) > 0)
    return F.when(t.rlike(ASSIGNED), F.array_distinct(F.concat(free, kept))).otherwise(free)


def features(found: Column, path: Column, dictionary: list[str]) -> list[Column]:
    """Numbers for the forest, in a fixed order, of one candidate."""
    value, before, after = (found.getField(f) for f in ("value", "before", "after"))
    length = F.length(value).cast("double")
    runs = value
    for kind, mark in (("[a-z]+", "!"), ("[A-Z]+", "%"), ("[0-9]+", "#"), ("[_+/.@=-]+", "~")):
        runs = F.regexp_replace(runs, kind, mark)
    share = lambda pattern: F.length(F.regexp_replace(value, pattern, "")) / length
    if dictionary:
        words = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))
        uncovered = F.length(F.regexp_replace(F.lower(value), f"({words})", "")) / length
    else:
        uncovered = F.lit(1.0)
    word = F.regexp_extract(before, r"([A-Za-z_]+)[^A-Za-z_]*$", 1)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return [
        length,
        (F.length(runs) - 1) / length,
        share("[^0-9]"),
        share("[^A-Z]"),
        share("[^a-f0-9]"),
        F.size(F.array_distinct(F.split(value, ""))) / length,
        1 - uncovered,
        flag(value.rlike("[/@]") | before.rlike("[/@]$") | after.rlike("^[/@]")),
        F.length(F.regexp_replace(value, "[^.]", "")).cast("double"),
        flag(path.rlike(TEST_PATH)),
        flag(word.rlike(CREDENTIAL)),
        flag(before.rlike(r"[=:]\s*[\"']?$")),
        flag(before.rlike(r"[\"']$")),
        flag(after.rlike(r"^[\s\"']*[A-Za-z]+[\s,.]")),
    ]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source", every: bool = False) -> DataFrame:
    """``key, path, found``: one row for each different candidate of each row, at its first
    place, or, with ``every``, for each place of each candidate."""
    rows = docs.select(F.col(key).alias("key"), F.col(path).cast("string").alias("path"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = F.when(F.col("t").rlike(f"[0-9]|{CREDENTIAL}"), candidates("t"))
    if not every:
        rows = add_once(rows, "all", F.array_sort(found, lambda a, b: a["start"] - b["start"]))
        rows = add_once(rows, "values", F.transform("all", lambda c: c["value"]))
        found = F.filter("all", lambda c, i: F.array_position("values", c["value"]) == i + 1)
    rows = rows.select("key", "path", F.explode(found).alias("found"))
    return rows.withColumnRenamed("key", key)


def label_by_format(found: Column) -> Column:
    """Labels of findings that a strict format decides: 1, 0, or null.

    Keys of one provider's fixed form, and values assigned to a credential word that are
    long or, in quotes, mix kinds of characters are secrets; mail and network addresses,
    host names, bare numbers and unquoted plain words are none.
    """
    value, before = found.getField("value"), found.getField("before")
    assigned = before.rlike(rf"{CREDENTIAL}[A-Za-z0-9_-]*[\"'`\]]*\s*[=:]>?\s*[\"'`]?$")
    quoted = before.rlike("[\"'`]$")
    kinds = sum(value.rlike(k).cast("int") for k in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    mixed = assigned & quoted & (kinds >= 2) & value.rlike(r"^\S{6,}$") & ~value.rlike("^[A-Z]?[a-z]+$")
    none = value.rlike(r"^[0-9.+-]+$") | value.rlike(r"^[^@]+@[^@]+\.[a-z]+$") | value.rlike(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$")
    none = none | (~quoted & value.rlike("^[A-Z]?[a-z]+$"))
    long = assigned & value.rlike("^[A-Za-z0-9+/_-]{16,}=*$")
    return F.when(none, 0).when(value.rlike("^AKIA[0-9A-Z]{16}$") | long | mixed, 1)


def common_words(findings: DataFrame, limit: int = DICTIONARY) -> list[str]:
    """The words of three letters or more that stand beside the most findings."""
    beside = F.concat_ws(" ", "found.before", "found.after")
    words = F.array_distinct(F.regexp_extract_all(F.lower(beside), F.lit(r"(?<![\p{L}0-9])[a-z]{3,}(?![\p{L}0-9])"), F.lit(0)))
    rows = findings.select(F.explode(words).alias("word")).groupBy("word").count()
    return [r["word"] for r in rows.orderBy(F.desc("count"), "word").limit(limit).collect()]


def train_forest(
    labelled: DataFrame, dictionary: list[str], part_rows: int = PART_ROWS, trees: int = TREES, depth: int = DEPTH
) -> Forest:
    """A forest from ``found, path, label`` (1: a secret), all rows of them, dealt by a hash in
    parts of about ``part_rows``.  Labels that are null are left out; with labels of one
    kind only, everything is of that kind, and nothing is a secret without any."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    names = [f"f{i}" for i in range(N_FEATURES)]
    labelled = labelled.where("label is not null").select(
        F.col("label").cast("double").alias("label"), F.xxhash64("found").alias("place"),
        *(f.cast("double").alias(n) for n, f in zip(names, features(F.col("found"), F.col("path"), dictionary))),
    )
    # equal rows are counted together, so that many of them need not meet in one part
    labelled = materialize(labelled.groupBy("label", "place", *names).agg(F.count(F.lit(1)).alias("copies")))
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.sum("copies").alias("n")).collect()}
    if len(sizes) < 2:
        return Forest([next(iter(sizes), 0.0)], dictionary)
    each = labelled.select("label", "place", *names, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    low, high = (
        each.where(F.col("label") == label).repartition(max(1, -(-sizes.get(label, 0) // part_rows)), "place", "copy")
        .sortWithinPartitions("place", *names, "copy").select("label", "place", *names)
        for label in (0.0, 1.0)
    )
    part = materialize(low.unionByName(high))
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(part).select("label", "features")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="sqrt").fit(rows)
    return Forest(_parse(model.toDebugString), dictionary)


def _parse(described: str) -> list[Tree]:
    lines = [line.strip() for line in described.splitlines()[1:] if line.strip()]
    at = 0

    def tree() -> Tree:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return float(line.split()[-1])
        feature, threshold = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = tree()
        at += 1  # the line of the other branch
        return int(feature), float(threshold), low, tree()

    found = []
    while at < len(lines):
        at += 1  # the line of the tree
        found.append(tree())
    return found


def forest_score(values: list[Column], forest: Forest) -> Column:
    """Share of the trees that call a candidate a secret."""

    def column(tree: Tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, threshold, low, high = tree
        return F.when(values[feature] <= threshold, column(low)).otherwise(column(high))

    total = F.lit(0.0)
    for tree in forest.trees:
        total = total + column(tree)
    return total / len(forest.trees)


def score_findings(findings: DataFrame, forest: Forest) -> DataFrame:
    """Add ``score`` and ``is_secret`` (a score of one half or more)."""
    numbers = F.array(*(v.cast("double") for v in features(F.col("found"), F.col("path"), forest.dictionary)))
    rows = add_once(findings, "__numbers", numbers)
    values = [F.col("__numbers")[i] for i in range(N_FEATURES)]
    rows = rows.withColumn("score", forest_score(values, forest)).drop("__numbers")
    return rows.withColumn("is_secret", F.col("score") >= 0.5)


def redact(docs: DataFrame, forest: Forest, text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``MASK``, wherever it stands on its own.

    A value is a secret where one of its places makes it one; longer runs that merely contain
    it stay.
    Texts without one, null ones included, stay as they are; so do all other columns.
    """
    numbers = lambda c: F.array(*(v.cast("double") for v in features(c, F.col(path).cast("string"), forest.dictionary)))
    found = F.when(F.col(text).rlike(f"[0-9]|{CREDENTIAL}"), candidates(text))
    rows = add_once(docs, "__found", found)
    judged = F.transform("__found", lambda c: F.struct(c["value"].alias("value"), numbers(c).alias("numbers")))
    rows = add_once(rows, "__judged", F.when(F.size("__found") > 0, judged))
    secret = lambda c: forest_score([c["numbers"][i] for i in range(N_FEATURES)], forest) >= 0.5
    secrets = F.array_distinct(F.transform(F.filter("__judged", secret), lambda c: c["value"]))
    rows = add_once(rows, "__secrets", F.array_sort(secrets, lambda a, b: F.length(b) - F.length(a)))
    literal = lambda s: F.regexp_replace(s, r"([^\p{L}\p{N}\s])", r"\\$1")
    any_of = F.array_join(F.transform("__secrets", literal), "|")
    alone = F.concat(F.lit(f"(?<![{CHARS}])(?:"), any_of, F.lit(")(?![.@/-]*+[A-Za-z0-9_+])"))
    masked = F.regexp_replace(F.col(text), alone, F.lit(MASK))
    replaced = F.when(F.size("__secrets") > 0, masked).otherwise(F.col(text))
    return rows.select(*(replaced.alias(c) if c == text else F.col(c) for c in docs.columns))
