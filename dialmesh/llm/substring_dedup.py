"""Removal of repeated passages, by super-k-mers.

A window is ``size`` consecutive words of one document.  Its minimiser is the smallest hash
among the ``M`` word sequences of ``GRAM`` words in it.  Consecutive windows with the same
minimiser travel as one packed string of words (a super-k-mer) to the bucket of that
minimiser, where equal windows must meet; sorting counts them exactly.

* A first pass lists the minimisers of each document.  A minimiser met once in all
  documents cannot belong to a repeated window, so only strings of repeated ones travel.
* Equal strings are counted together before they go to a bucket and stand there once,
  so copies of a document weigh nothing.
* A minimiser with very many different strings (a passage within many documents) is hot:
  its strings are dealt over several buckets.  Each finds what repeats within itself, and
  only what it has found once there, and one fingerprint (128 bits) of what it has found
  repeated, meet those of the other buckets of that minimiser.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BucketedTable, materialize
from .common import map_batches, release_memory, slices
from .word_hashes import split_words, window_hashes

SIZE = 35
GRAM = 8
TEXT_BYTES = 1_000_000  # text handled at a time
HOT_STRINGS = 128  # different strings of one minimiser in a bucket


def _super_kmers(words, size: int):
    """``document, start, windows, minimiser, repeats`` of every super-k-mer.

    ``repeats`` tells that the string may hold a window twice: its minimiser occurs twice.
    """
    grams = window_hashes(words.hashes(), GRAM)
    span = size - GRAM + 1
    least, width = grams, 1
    while width < span:  # smallest of `width` grams from each on
        step = min(width, span - width)
        ahead = np.append(least[step:], np.full(step, np.iinfo(np.uint64).max))[: len(least)]
        least, width = np.minimum(least, ahead), width + step
    counts = words.counts()
    place = np.arange(len(words)) - np.repeat(words.first[:-1], counts)
    window = np.flatnonzero(place + size <= np.repeat(counts, counts))  # starts of windows
    document = np.repeat(np.arange(len(counts)), counts)[window]
    minimiser = least[window]
    if not len(window):
        return document, window, window, minimiser, np.zeros(0, bool)
    new = np.r_[True, (np.diff(minimiser) != 0) | (np.diff(window) != 1)]
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(window)])
    # occurrences of the minimiser within the string
    lengths = n + span - 1
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(window[first], lengths)
    same = grams[at] == np.repeat(minimiser[first], lengths)
    repeats = np.add.reduceat(same.astype(np.int64), ends - lengths) > 1
    return document[first], window[first], n, minimiser[first], repeats


def remove_repeats(
    docs: DataFrame, size: int = SIZE, hot: int = HOT_STRINGS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` of each row.

    A word is removed when a window that covers it has a word sequence that starts anywhere
    else too, in the same document or another; windows are judged on the input.  Kept words
    are joined by one blank.  Null texts count as empty; texts shorter than a window lose
    nothing.  Rows may share a key or have none, and a repeated row is a document of its
    own, so all its windows repeat.
    """
    summary, cut = _repeats(docs, size, hot, key, text)
    cut = cut.drop("kept_text").dropDuplicates(["id", "mark"])
    result = summary.select("key", "id", "mark", "n_words", "kept_sha256").join(cut, ["id", "mark"], "left")
    return result.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("sha", "kept_sha256").alias("kept_sha256"),
    )


def cut_repeats(
    docs: DataFrame, size: int = SIZE, hot: int = HOT_STRINGS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without the words that ``remove_repeats`` removes.

    Texts that lose nothing, null ones included, stay as they are, as do all other columns;
    what is left of the others are words joined by one blank.
    """
    _, cut = _repeats(docs, size, hot, key, text)
    cut = cut.dropDuplicates(["id", "mark"]).select(
        F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.col("kept_text").alias("__kept")
    )
    plain = F.coalesce(F.col(text), F.lit(""))
    names = [c.alias(n) for c, n in zip(row_id(key, plain), ("__id", "__mark"))]
    rows = docs.select("*", *names).join(cut, ["__id", "__mark"], "left")
    return rows.select(*(F.coalesce("__kept", c).alias(c) if c == text else F.col(c) for c in docs.columns))


def _repeats(docs: DataFrame, size: int, hot: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """A summary of every row, and what is left of those that lose words."""
    kind = docs.schema[key].dataType.simpleString()
    plain = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("key"), plain.alias("text"), *row_id(key, plain))
    summary = materialize(map_batches(
        texts, lambda: _summaries(size),
        f"key {kind}, id bigint, mark bigint, n_words bigint, kept_sha256 string, "
        "starts array<int>, minimisers array<bigint>, repeats array<boolean>",
    ))
    kmers = summary.select("id", F.explode(F.arrays_zip("starts", "minimisers", "repeats")).alias("k"))
    kmers = kmers.select("id", F.col("k.starts").alias("start"), F.col("k.minimisers").alias("minimiser"), "k.repeats")
    times = F.count(F.lit(1)) + F.sum(F.col("repeats").cast("int"))
    met = materialize(kmers.groupBy("minimiser").agg(times.alias("n")).where("n > 1").select("minimiser"))
    wanted = kmers.select("id", "start", "minimiser").join(met, "minimiser", "left_semi")
    wanted = wanted.groupBy("id").agg(F.collect_set("start").alias("starts"))
    once, copies = _repeated_rows(texts.select("id", "mark", "text"), summary)
    found = BucketedTable(once.join(wanted, "id"), "id")
    places = materialize(map_batches(
        found.df.select("text", "starts", "id", "mark"), lambda: _places(size),
        "id bigint, mark bigint, start int, minimiser bigint, string_id binary",
    ))
    counted = places.withColumn("n", F.lit(1)) if copies is None else (
        places.join(copies, ["id", "mark"], "left").withColumn("n", F.coalesce("copies", F.lit(1)))
    )
    repeated = _repeated_windows(found.df, counted, size, hot)
    covers = places.select("id", "mark", "start", "string_id").join(repeated, "string_id")
    covers = covers.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "windows")).alias("covers"))
    covers = covers.select("id", F.col("mark").alias("cover_mark"), "covers")
    cut = map_batches(
        found.df.select("text", "id", "mark").join(covers, "id").select("text", "covers", "id", "mark", "cover_mark"),
        lambda: _cut(size), "id bigint, mark bigint, n_removed bigint, sha string, kept_text string",
    )
    return summary, cut


def _repeated_rows(texts: DataFrame, summary: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Each row once by ``id, mark``, and how many ``copies`` the repeated ones have.

    Windows of equal rows are read and cut once; the count stands for the other copies.
    """
    copies = summary.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("copies"))
    copies = materialize(copies.where("copies > 1"))
    if copies.isEmpty():
        return texts, None
    name = ["id", "mark"]
    single = texts.join(copies, name, "left_anti")
    return single.unionByName(texts.join(copies, name, "left_semi").dropDuplicates(name)), copies


def row_id(key: str, text: Column) -> list[Column]:
    """Two hashes that name a row by its key and text; equal rows share them."""
    return [F.xxhash64(F.col(key), text).alias("id"), F.xxhash64(text, F.col(key), F.lit(1)).alias("mark")]


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """One list per owner 0 to n - 1 from values in the order of their owners."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _summaries(size: int):
    def step(batch):
        keys, texts, ids, marks = batch.columns
        for texts, keys, ids, marks in slices(texts, keys, ids, marks, size=TEXT_BYTES):
            words = split_words(texts)
            n = len(texts)
            document, start, _, minimiser, repeats = _super_kmers(words, size)
            buffer, at = words.joined()
            sha = [
                hashlib.sha256(buffer[at[a] : max(at[a], at[b] - 1)]).hexdigest()
                for a, b in zip(words.first[:-1], words.first[1:])
            ]
            yield [
                keys, ids, marks, pa.array(words.counts(), pa.int64()), pa.array(sha),
                _lists((start - words.first[document]).astype(np.int32), document, n, pa.int32()),
                _lists(minimiser.view(np.int64), document, n, pa.int64()),
                _lists(repeats, document, n, pa.bool_()),
            ]

    return step


def _chosen(words, starts: pa.Array, size: int):
    """Super-k-mers whose starts (words of their document) are listed."""
    document, start, windows, minimiser, _ = _super_kmers(words, size)
    listed = np.repeat(np.arange(len(starts)), np.diff(starts.offsets.to_numpy()))
    listed = (listed << 32) + starts.flatten().to_numpy()
    local = start - words.first[document]
    own = np.flatnonzero(np.isin((document << 32) + local, listed))
    return document[own], start[own], local[own], windows[own], minimiser[own]


def _packed(words, start: np.ndarray, windows: np.ndarray, size: int) -> list[memoryview]:
    buffer, at = words.joined()
    return [buffer[a:b] for a, b in zip(at[start].tolist(), (at[start + windows + size - 1] - 1).tolist())]


def _places(size: int):
    def step(batch):
        for texts, starts, ids, marks in slices(*batch.columns, size=TEXT_BYTES):
            words = split_words(texts)
            document, start, local, windows, minimiser = _chosen(words, starts, size)
            strings = _packed(words, start, windows, size)
            names = [xxhash.xxh3_128_digest(s) for s in strings]
            of = pa.array(document)
            yield [
                ids.take(of), marks.take(of), pa.array(local, pa.int32()),
                pa.array(minimiser.view(np.int64), pa.int64()), pa.array(names, pa.binary()),
            ]

    return step


def _repeated_windows(found: DataFrame, places: DataFrame, size: int, hot: int) -> DataFrame:
    """``string_id, windows``: the windows of each different string that occur elsewhere."""
    different = materialize(places.groupBy("minimiser", "string_id").agg(
        F.sum("n").cast("long").alias("n"), F.min(F.struct("id", "mark", "start")).alias("one")
    ))
    per_bucket = different.groupBy("minimiser").agg(F.count(F.lit(1)).alias("strings"))
    hot_ones = materialize(per_bucket.where(F.col("strings") > hot))
    dealt = F.ceil(F.col("strings") / hot).cast("int")
    different = different.join(hot_ones, "minimiser", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("string_id"), dealt) + 1, F.lit(0)).cast("int")
    )
    senders = different.groupBy(F.col("one.id").alias("id"), F.col("one.mark").alias("sender")).agg(
        F.collect_list(F.struct("one.start", "n", "salt")).alias("sent")
    )
    sent = found.select("id", "mark", "text").join(senders, "id").where("mark = sender").select("text", "sent")
    strings = map_batches(
        sent, lambda: _strings(size), "minimiser bigint, salt int, string_id binary, n bigint, packed string"
    )
    buckets = strings.repartition("minimiser", "salt").sortWithinPartitions("minimiser", "salt")
    counted = materialize(buckets.mapInArrow(
        _count_windows(size),
        "string_id binary, windows array<int>, open_at array<int>, open array<binary>, seen array<binary>",
    ))
    here = counted.where("windows is not null").select("string_id", "windows")
    once = counted.where("open is not null").select("string_id", F.explode(F.arrays_zip("open", "open_at")).alias("w"))
    once = once.select("string_id", F.col("w.open").alias("print"), F.col("w.open_at").alias("window"))
    twice = counted.where("seen is not null").select(F.explode("seen").alias("print"), F.lit(2).alias("n"))
    met = once.select("print", F.lit(1).alias("n")).unionByName(twice).groupBy("print").agg(F.sum("n").alias("n"))
    met = materialize(met.where("n > 1").select("print"))
    elsewhere = once.join(met, "print", "left_semi").groupBy("string_id").agg(F.collect_list("window").alias("windows"))
    return here.unionByName(elsewhere)


def _strings(size: int):
    def step(batch):
        for texts, sent in slices(*batch.columns, size=TEXT_BYTES):
            rows = sent.flatten()
            owner = np.repeat(np.arange(len(sent)), np.diff(sent.offsets.to_numpy()))
            start, n, salt = (rows.field(i).to_numpy() for i in range(3))
            words = split_words(texts)
            document, first, local, windows, minimiser = _chosen(
                words, _lists(start, owner, len(sent), pa.int32()), size
            )
            wanted = (owner << 32) + start
            order = np.argsort(wanted)
            of = order[np.searchsorted(wanted[order], (document << 32) + local)]
            strings = _packed(words, first, windows, size)
            yield [
                pa.array(minimiser.view(np.int64), pa.int64()), pa.array(salt[of], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(s) for s in strings], pa.binary()),
                pa.array(n[of], pa.int64()), pa.array([bytes(s).decode() for s in strings], pa.string()),
            ]

    return step


def _count_windows(size: int):
    """From strings sorted by bucket, of which a bounded number share one."""

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            ends = np.flatnonzero(_bucket_ends(table))  # a bucket is whole once the next began
            if not len(ends):
                rest = table
                continue
            rest = table.slice(int(ends[-1]) + 1)
            for part in _parts(table.slice(0, int(ends[-1]) + 1)):
                yield from _windows_of(part, size)
            del batch, table, part
            release_memory()
        if rest is not None and len(rest):
            for part in _parts(rest):
                yield from _windows_of(part, size)

    return run


def _parts(table: pa.Table):
    """Whole buckets, cut where one ends so that their strings hold about TEXT_BYTES."""
    ends = np.r_[np.flatnonzero(_bucket_ends(table)) + 1, len(table)]
    sizes = np.cumsum(pc.binary_length(table.column(4)).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(table):
        base = sizes[at - 1] if at else 0
        fit = np.searchsorted(ends, np.searchsorted(sizes, base + TEXT_BYTES, "right"), "right") - 1
        end = int(ends[max(fit, np.searchsorted(ends, at, "right"))])
        yield table.slice(at, end - at)
        at = end


def _bucket_ends(table: pa.Table) -> np.ndarray:
    minimiser, salt = table.column(0).to_numpy(), table.column(1).to_numpy()
    return (minimiser[1:] != minimiser[:-1]) | (salt[1:] != salt[:-1])


def _windows_of(table: pa.Table, size: int):
    packed = table.column(4).combine_chunks()
    parts = pc.split_pattern(packed, " ")
    ends = parts.offsets.to_numpy()[1:] - parts.offsets.to_numpy()[0]
    classes, width = parts.flatten().dictionary_encode().indices.to_numpy().astype(np.int64), 1
    # classes of equal sequences of 1, 2, 4 ... words from each word on, by sorting pairs
    while width < size:
        step = min(width, size - width)
        ahead = np.append(classes[step:], np.zeros(step, np.int64))[: len(classes)]
        classes = np.unique(classes * (classes.max() + 1) + ahead, return_inverse=True)[1]
        width += step
    # equal windows of different buckets of one minimiser are counted later
    bucket = np.r_[0, np.cumsum(_bucket_ends(table))]
    lengths = np.diff(np.r_[0, ends])
    string = np.repeat(np.arange(len(ends)), lengths)
    place = np.arange(len(classes)) - np.repeat(ends - lengths, lengths)
    window = np.flatnonzero(place + size <= lengths[string])
    owner = string[window]
    _, one, same = np.unique(
        classes[window] * (bucket[-1] + 1) + bucket[owner], return_index=True, return_inverse=True
    )
    often = np.bincount(same, weights=table.column(3).to_numpy()[owner]) > 1
    repeated = often[same]
    dealt = table.column(1).to_numpy()[owner] > 0
    is_open = dealt & ~repeated
    seen = one[often & dealt[one]]
    words = split_words(packed)
    buffer, at = words.joined()

    def prints(chosen: np.ndarray) -> pa.Array:
        begin, end = at[window[chosen]], at[window[chosen] + size] - 1
        return pa.array([xxhash.xxh3_128_digest(buffer[a:b]) for a, b in zip(begin.tolist(), end.tolist())], pa.binary())

    def lists(chosen: np.ndarray, values: pa.Array) -> pa.Array:
        has, first = np.unique(owner[chosen], return_index=True)
        made = pa.ListArray.from_arrays(pa.array(np.r_[first, len(chosen)].astype(np.int32)), values)
        back = np.full(len(lengths), -1)
        back[has] = np.arange(len(has))
        return made.take(pa.array(back, mask=back < 0))

    hits, opened = np.flatnonzero(repeated), np.flatnonzero(is_open)
    names = ["string_id", "windows", "open_at", "open", "seen"]
    no_seen = pa.nulls(len(lengths), pa.list_(pa.binary()))
    yield pa.RecordBatch.from_arrays([
        table.column(2).combine_chunks(), lists(hits, pa.array(place[window[hits]], pa.int32())),
        lists(opened, pa.array(place[window[opened]], pa.int32())), lists(opened, prints(opened)), no_seen,
    ], names)
    if len(seen):
        none = pa.nulls(1, pa.list_(pa.int32()))
        listed = pa.ListArray.from_arrays(pa.array([0, len(seen)], pa.int32()), prints(seen))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.binary()), none, none, pa.nulls(1, pa.list_(pa.binary())), listed], names
        )


def _cut(size: int):
    def step(batch):
        same = pc.equal(batch.column(3), batch.column(4))
        texts, covers, ids, marks, _ = batch.filter(same).columns
        for texts, covers, ids, marks in slices(texts, covers, ids, marks, size=TEXT_BYTES):
            words = split_words(texts)
            buffer, at = words.joined()
            spans = covers.flatten()
            lists = spans.field(1)
            per_list = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(covers)), np.diff(covers.offsets.to_numpy()))
            first = words.first[np.repeat(owner, per_list)]
            window = first + np.repeat(spans.field(0).to_numpy(), per_list) + lists.flatten().to_numpy()
            change = np.zeros(len(words) + size + 1, np.int64)
            np.add.at(change, window, 1)
            np.add.at(change, window + size, -1)
            gone = np.cumsum(change)[: len(words)] > 0
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) if len(texts) else []
            kept = []
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                left = a + np.flatnonzero(np.diff(np.r_[True, gone[a:b], True].astype(np.int8)))
                runs = zip(left[::2].tolist(), left[1::2].tolist())
                kept.append(b" ".join(buffer[at[x] : at[y] - 1] for x, y in runs))
            yield [
                ids, marks, pa.array(removed, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k.decode() for k in kept]),
            ]

    return step
