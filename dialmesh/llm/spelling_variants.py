"""Words one edit apart, found with an index of variable-length grams.

A word stands between ``^`` and ``$``.  At each place its gram grows from two characters
until fewer than T of all grams are like it; a place whose grams stay frequent to eight
characters or the end of the word gives none.  The dictionary is the frequent grams alone,
pruned by T, which bounds their number.  What a gram is depends on its own characters only,
so an edit touches just the grams that lie over it.

The lists of a few grams of a word are merged: so many that the bound on those an edit can
touch is below their number, so every word one edit away is in one of the lists.  Grams that
share no place do with the fewest, two lists with a bound of one; the two that are rarest
together are taken, and as every list is shorter than T, none is long.  The merged words are
verified by their edit distance.

Words without two grams apart, all of which one edit could touch, take the next T, eight
times as large, with shorter grams; at the last T the dictionary is empty and all grams have
two characters.  An untouched gram stands at the same place or is shifted by the difference
in length, so lists are kept by gram, place and length, and a word asks for those of its own
length and of the next one; pairs count in both orders.

Every join is by sort and merge: there are as many rows as words or more, and Spark takes its
sizes from compressed files of words, not knowing how many rows an explode makes of each.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_batches

SHORTEST, LONGEST = 2, 8  # characters of a gram
LEAST_FREQUENT = 32  # the first T, unless more grams than the dictionary holds are as frequent
DICTIONARY = 400_000  # grams at most, about 50 MB in a Python worker
LADDER = 8
LEAST_LENGTH = 3  # of words: shorter ones may have no gram left by an edit


def _gram_counts(words: DataFrame) -> DataFrame:
    marked = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("m"))
    sizes = F.expr(f"filter(sequence({SHORTEST}, {LONGEST}), q -> q <= length(m))")
    grams = F.flatten(F.transform(sizes, lambda q: F.transform(
        F.sequence(F.lit(1), F.length("m") - q + 1), lambda i: F.substring(F.col("m"), i, q))))
    return marked.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def _dictionary(words: DataFrame) -> tuple[dict[str, int], int]:
    """Frequent grams with their counts, and the least count of a frequent one.

    All counts together are at most (LONGEST - SHORTEST + 1) per character, so at most
    DICTIONARY grams reach the limit that follows from it.
    """
    characters = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    limit = max(LEAST_FREQUENT, -(-characters * (LONGEST - SHORTEST + 1) // DICTIONARY))
    frequent = _gram_counts(words).where(F.col("n") >= limit).toArrow()
    return dict(zip(frequent["gram"].to_pylist(), frequent["n"].to_pylist())), limit


def grams_of(word: str, frequent: dict[str, int], limit: int) -> list[tuple[int, str]]:
    """``(place, gram)`` of a word: the shortest gram at each place that is not frequent."""
    marked = f"^{word}$"
    found = []
    for i in range(len(marked) - SHORTEST + 1):
        for end in range(i + SHORTEST, min(i + LONGEST, len(marked)) + 1):
            if frequent.get(marked[i:end], 0) < limit:
                found.append((i, marked[i:end]))
                break
    return found


def most_affected(word: str, grams: list[tuple[int, str]]) -> int:
    """Grams that one edit can touch at most."""
    cover = [0] * (len(word) + 2)
    for place, gram in grams:
        for i in range(place, place + len(gram)):
            cover[i] += 1
    return max(cover[1:-1], default=0)


def merged_grams(word: str, frequent: dict[str, int], limit: int) -> tuple[int, list[tuple[int, str]]]:
    """The limit under which one edit leaves a gram of the word, and the two grams to look up."""
    while True:
        grams = grams_of(word, frequent, limit)
        counts = [frequent.get(gram, 0) for _, gram in grams]
        best, first, chosen = None, None, []
        ended = 0  # grams so far that end before the present one begins; ends rise with places
        for j, (place, gram) in enumerate(grams):
            while ended < j and grams[ended][0] + len(grams[ended][1]) <= place:
                if first is None or counts[ended] < counts[first]:
                    first = ended
                ended += 1
            if first is not None and (best is None or counts[first] + counts[j] < best):
                best, chosen = counts[first] + counts[j], [grams[first], grams[j]]
        if chosen:
            return limit, chosen
        limit *= LADDER


def _key(limit: int, gram: str, place: int, length: int) -> str:
    return f"{limit} {place} {length} {gram}"


def _lookups(words: DataFrame, frequent, limit: int) -> DataFrame:
    """``word, n, limit, keys``: lists to merge for each word, of its length and the next."""

    def make():
        known = frequent.value

        def step(batch):
            names, counts = batch.columns
            limits, keys = [], []
            for word in names.to_pylist():
                used, grams = merged_grams(word, known, limit)
                size = len(word)
                limits.append(used)
                keys.append([_key(used, g, i + by, size + more) for i, g in grams for more, by in ((0, 0), (1, 0), (1, 1))])
            yield [names, counts, pa.array(limits, pa.int64()), pa.array(keys, pa.list_(pa.string()))]

        return step

    return map_batches(words, make, "word string, n bigint, `limit` bigint, keys array<string>")


def _postings(words: DataFrame, frequent, limits: list[int]) -> DataFrame:
    """``near, near_n, keys``: the lists that each word is in."""

    def make():
        known = frequent.value

        def step(batch):
            names, counts = batch.columns
            keys = [
                [_key(limit, g, i, len(word)) for limit in limits for i, g in grams_of(word, known, limit)]
                for word in names.to_pylist()
            ]
            yield [names, counts, pa.array(keys, pa.list_(pa.string()))]

        return step

    return map_batches(words, make, "near string, near_n bigint, keys array<string>")


def _by_key(rows: DataFrame) -> DataFrame:
    """One row per list; different lists of one hash only bring words that fail to verify."""
    names = rows.columns[:2]
    return rows.select(*names, F.explode("keys").alias("key")).select(*names, F.xxhash64("key").alias("key"))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: pairs of distinct words that one inserted, deleted or replaced
    code point makes equal, each in both orders.  ``words`` has ``word, n``, words once."""
    spark = words.sparkSession
    frequent, limit = _dictionary(words)
    shared = spark.sparkContext.broadcast(frequent)
    lookups = materialize(_lookups(words, shared, limit))
    limits = sorted(r[0] for r in lookups.select("limit").distinct().collect())  # few: powers of LADDER
    lists = _postings(words, shared, limits)
    merged = _by_key(lookups).hint("merge").join(_by_key(lists), "key")
    near = merged.where((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))
    there = F.struct("word", "n", "near", "near_n")
    back = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    both = near.select(F.explode(F.when(F.length("word") == F.length("near"), F.array(there)).otherwise(F.array(there, back))).alias("p"))
    return both.select("p.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each word's chain of ``word, form``.

    Every step doubles the part of its chain that a word has passed.
    """
    chain = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = chain.hint("merge").join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        stepped = materialize(stepped)
        chain = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return chain


def spelling_variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of counted words ``word, n``.

    ``form`` is the near word (one edit away) of largest ``n``, among equals the smallest in
    code-point order, if it is at least ``factor`` (2 or more) times as frequent as the word;
    ``root`` is where forms lead at last, the word itself if it has none.  Rows of one word
    count together; null words and those under three code points are left out.
    """
    if factor < 2:
        raise ValueError("factor: 2 or more, or forms could lead in a circle")
    own = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))
    own = materialize(own)
    near = near_words(own).unionByName(
        own.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("bigint").alias("near_n"))
    )
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("n"), "near")))
    judged = near.groupBy("word", "n").agg(F.count("near").alias("n_near"), best.alias("best"))
    strong = -F.col("best.n") >= factor * F.col("n")
    judged = materialize(judged.select(
        "word", "n", "n_near",
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.n")).alias("form_n"),
    ))
    roots = _roots(judged.where("form is not null"))
    return judged.hint("merge").join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
