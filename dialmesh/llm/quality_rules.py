"""Quality rules: statistics of whole texts and a decision list learned from labels.

Everything is column expressions and aggregations.  The list is learned by sequential
covering: a rule grows condition by condition (a statistic at or beyond a threshold, chosen
by information gain on two thirds of the labelled rows), loses the conditions that do not
help on the other third, takes its rows out, and the next rule follows.  The result is one
ordered conditional expression that anyone can read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import add_once
from ..session import materialize

WINDOW = 8
SPLIT = r"[\x20\x09-\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks")
#: Statistics that rules may use, from the counts; texts without words count as 0 in each.
FEATURES = {
    "word_length": "try_divide(word_chars, n_words)",
    "symbols_per_word": "try_divide(n_symbols, n_words)",
    "dup_lines_per_word": "try_divide(n_dup_lines, n_words)",
    "repeated_share": "try_divide(n_repeat_words, n_words)",
    "marks_per_word": "try_divide(n_marks, n_words)",
}
QUANTILES = 32
MAX_RULES, MAX_CONDITIONS = 10, 4
MAX_FAILED = 12  # rules that may fail the pruning, each time without the condition they began with


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the columns ``COUNTS`` (long) of each row; null texts count as empty.

    ``word_chars`` are code points in words, ``n_symbols`` characters of ``#*$%&|<>``,
    ``n_dup_lines`` lines with a word that equal an earlier line, ``n_repeat_words`` words in
    windows of eight that occur twice or more in the text, the first included, ``n_marks``
    exclamation marks.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = add_once(rows, "lines", lines).select(
        "key", "t",
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        (F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit("")))).alias("n_marks"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
    )
    kept = ["key", "n_symbols", "n_marks", "n_dup_lines", "n_words", "word_chars"]
    rows = add_once(rows, "w", F.array_remove(F.split("t", SPLIT), "")).drop("t").withColumns(
        {"n_words": F.size("w"), "word_chars": F.length(F.array_join("w", ""))}
    )
    rows = add_once(rows, "windows", F.transform("w", lambda x: F.xxhash64(x))).drop("w")
    width = 1
    while width < WINDOW:  # hashes of twice as many words from those of neighbours
        rows = rows.withColumnRenamed("windows", "halves")
        n = F.greatest(F.size("halves") - width, F.lit(0))
        pairs = F.zip_with(F.slice("halves", 1, n), F.slice("halves", width + 1, n), lambda x, y: F.xxhash64(x, y))
        rows = add_once(rows, "windows", pairs).drop("halves")
        width *= 2
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    rows = add_once(rows, "sorted", F.when(twice, placed)).drop("windows")

    def repeated(x, i):
        other = lambda k: F.coalesce(F.get("sorted", k)["h"] == x["h"], F.lit(False))
        return other(i - 1) | other(i + 1)

    places = F.sort_array(F.transform(F.filter("sorted", repeated), lambda x: x["p"]))
    rows = add_once(rows.select(*kept, "sorted"), "places", places)
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    rows = rows.select(*kept, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    return rows.select(F.col("key").alias(key), *(F.col(c).cast("long").alias(c) for c in COUNTS))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.coalesce(F.expr(FEATURES[self.feature]), F.lit(0.0))
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.4g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    column = F.lit(True)
    for condition in rule:
        column = column & condition.column()
    return column


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list rejects the row."""
    if not rules:
        return F.lit(True)
    column = F.when(holds(rules[0]), False)
    for rule in rules[1:]:
        column = column.when(holds(rule), False)
    return column.otherwise(True)


def learn_rules(labelled: DataFrame, key: str = "doc_id", max_rules: int = MAX_RULES) -> list[Rule]:
    """Rules for rows with ``quality`` 0 from all rows of ``labelled`` (``COUNTS, quality``).

    Rows without a label are left out.  Without rows of both kinds there are no rules.  A
    third of each kind judges the rules.
    """
    place = F.xxhash64(F.col(key), F.lit(3))
    rows = labelled.where("quality is not null").select(
        *COUNTS, (F.col("quality") == 0).cast("int").alias("low"), place.alias("place")
    )
    rows = materialize(rows)
    steps = [(i + 0.5) / QUANTILES for i in range(QUANTILES)]
    values = {f: F.coalesce(F.expr(e), F.lit(0.0)) for f, e in FEATURES.items()}
    cuts = rows.groupBy("low").agg(
        F.percentile_approx("place", 1 / 3, 1000).alias("third"),
        *(F.percentile_approx(v, steps, 1000).alias(f) for f, v in values.items()),
    ).collect()
    if len(cuts) < 2:
        return []
    third = {r["low"]: r["third"] for r in cuts}
    rows = rows.withColumn("judges", F.col("place") <= F.when(F.col("low") == 1, third[1]).otherwise(third[0]))
    thresholds = {
        f: sorted({(a + b) / 2 for r in [sorted({x for c in cuts for x in c[f]})] for a, b in zip(r, r[1:])})
        for f in FEATURES
    }
    rules: list[Rule] = []
    barred: set[Condition] = set()
    while len(rules) < max_rules and len(barred) <= MAX_FAILED:
        grown = _grow(rows, thresholds, barred)
        if not grown:
            break
        rule = _prune(rows, grown)
        if rule:
            rules.append(rule)
            rows = rows.where(~holds(rule))
        else:
            barred.add(grown[0])
    return rules


def _reached(feature: str, cuts: list[float]) -> Column:
    """How many thresholds of a statistic a row reaches."""
    value = F.coalesce(F.expr(FEATURES[feature]), F.lit(0.0))
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= value))


def _grow(rows: DataFrame, thresholds: dict[str, list[float]], barred: set[Condition]) -> Rule:
    """The best conditions one by one; no rule begins with a barred one."""
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        own = rows.where(~F.col("judges")).where(holds(rule))
        reached = [
            F.struct(F.lit(f).alias("feature"), _reached(f, t).alias("step")) for f, t in thresholds.items() if t
        ]
        if not reached:
            return ()
        steps = own.select("low", F.explode(F.array(*reached)).alias("r")).select("low", "r.*")
        table = steps.groupBy("feature", "step").agg(F.sum("low").alias("p"), F.sum(1 - F.col("low")).alias("n")).collect()
        best, gain = None, 1e-6
        for feature, cuts in thresholds.items():
            counts = {r["step"]: (r["p"], r["n"]) for r in table if r["feature"] == feature}
            p_all, n_all = (sum(c[i] for c in counts.values()) for i in (0, 1))
            if not p_all or not n_all:
                continue
            p, n = 0, 0
            for i, cut in enumerate(cuts):
                p, n = p + counts.get(i, (0, 0))[0], n + counts.get(i, (0, 0))[1]
                for at_least, a, b in ((False, p, n), (True, p_all - p, n_all - n)):
                    if a and (rule or Condition(feature, at_least, cut) not in barred):
                        new = a * (math.log2(a / (a + b)) - math.log2(p_all / (p_all + n_all)))
                        if new > gain:
                            best, gain = Condition(feature, at_least, cut), new
        if best is None:
            break
        rule += (best,)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of the rule that judges best; nothing if even that is wrong too often."""
    judges = rows.where("judges")
    sums = []
    for k in range(1, len(rule) + 1):
        met = holds(rule[:k]).cast("int")
        sums += [F.sum(met * F.col("low")).alias(f"p{k}"), F.sum(met * (1 - F.col("low"))).alias(f"n{k}")]
    counts = judges.agg(*sums).first()
    best, worth = (), 0.5  # share of low rows less that of others, as a rule must have more than three quarters
    for k in range(1, len(rule) + 1):
        p, n = counts[f"p{k}"] or 0, counts[f"n{k}"] or 0
        if p and (p - n) / (p + n) > worth:
            best, worth = rule[:k], (p - n) / (p + n)
    return best


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
