"""Toxicity by a convolutional text classifier, trained by Spark tasks in numpy.

A word is a sum of hashed embeddings: of the word and of its first four to seven bytes, so
that inflected forms share what they have in common.  Filters over one, two and three
consecutive words, each with its maximum over the text, feed a logistic output.  The score
is calibrated on labelled rows kept out of the fit, and so are the thresholds by language;
the language itself is never an input of a score.

Every labelled row is learned from.  Tasks fit the model further on portions of the rows, each
from the same start, and Spark averages what they changed; the average is the start of
the next round.  Only models, which are of a fixed size, and sums reach the driver.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..joins import BloomFilter
from ..session import materialize
from .common import map_batches, slices
from .word_hashes import MARKS, split_words

BUCKETS = 1 << 15
DIM = 12
PREFIXES = (4, 5, 6, 7)  # bytes
PARTS = 1 + len(PREFIXES)  # embeddings of a word
WIDTHS = (1, 2, 3)
FILTERS = 8
PORTION_ROWS = 6000  # labelled rows that a task fits on before changes are averaged
PORTION_WORDS = 6_000_000
ROUNDS = (1, 2, 3, 6)  # epochs on each portion before an average
BATCH = 32
BATCH_WORDS = 600_000
MODEL_BLOCKS = 64  # in which changes are averaged
STEP_WORDS = 60_000


def word_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``PARTS`` buckets for each word, and where the words of each text begin and end."""
    words = split_words(texts, lower=True, separates=MARKS)
    size = words.end - words.start
    data = np.append(words.data, np.zeros(8, np.uint8))
    out = np.empty((len(words), PARTS), np.uint16)
    mix, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - int(BUCKETS).bit_length() + 1)
    out[:, 0] = (words.hashes() * mix) >> shift
    prefix = np.zeros(len(words), np.uint64)
    for i in range(PREFIXES[-1]):
        byte = np.where(size > i, data[words.start + i], 0).astype(np.uint64)
        prefix = prefix << np.uint64(8) | byte
        if i + 1 in PREFIXES:
            mixed = (prefix ^ prefix >> np.uint64(27)) * mix
            out[:, PREFIXES.index(i + 1) + 1] = ((mixed ^ mixed >> np.uint64(31)) * mix) >> shift
    return out, words.first


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    bias: list[np.ndarray]
    weight: np.ndarray
    offset: float
    slope: float = 1.0  # calibration of the logit
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)  # of the score, by language
    prior: float | None = None  # the score of everything when labels of one kind are missing

    @classmethod
    def new(cls, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        return cls(
            normal(0.03, BUCKETS, DIM), [normal(0.3, w, DIM, FILTERS) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS], normal(0.3, len(WIDTHS) * FILTERS), 0.0,
        )

    def pool(self, buckets: np.ndarray, first: np.ndarray, places: bool = False):
        """Largest filter values of each text (at least 0), and where they stand."""
        n = len(first) - 1
        pooled = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        where = np.full(pooled.shape, -1, np.int64) if places else None
        vectors = self.embedding[buckets[:, 0]]
        for part in range(1, PARTS):
            vectors += self.embedding[buckets[:, part]]
        for k, (width, filters, bias) in enumerate(zip(WIDTHS, self.filters, self.bias)):
            long_enough = np.flatnonzero(np.diff(first) >= width)
            if not len(long_enough):
                continue
            values = vectors @ filters[0]
            for j in range(1, width):
                values[:-j] += (vectors @ filters[j])[j:]
            for j in range(1, width):  # windows that leave their text
                values[first[1:][long_enough] - j] = -np.inf
            short = np.flatnonzero(np.diff(first) < width)
            for d in short[np.diff(first)[short] > 0]:
                values[first[d] : first[d + 1]] = -np.inf
            starts = first[:-1][np.diff(first) > 0]
            top = np.maximum.reduceat(values, starts, axis=0)
            filled = np.flatnonzero(np.diff(first) > 0)
            columns = slice(k * FILTERS, (k + 1) * FILTERS)
            pooled[filled, columns] = np.maximum(top + bias, 0)
            if places:
                for row, d in enumerate(filled):
                    block = values[first[d] : first[d + 1]]
                    where[d, columns] = first[d] + block.argmax(0)
        if places:
            where[pooled <= 0] = -1
        return pooled, where

    def logits(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pool(buckets, first)[0].astype(float) @ self.weight + self.offset

    def raw_scores(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Logits before calibration."""
        out = np.empty(len(first) - 1)
        at = 0
        while at < len(out):  # texts of about STEP_WORDS words
            end = max(at + 1, int(np.searchsorted(first, first[at] + STEP_WORDS, "right")) - 1)
            part = buckets[first[at] : first[end]]
            out[at:end] = self.logits(part, first[at : end + 1] - first[at])
            at = end
        return out

    def scores(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(first) - 1, self.prior)
        return _sigmoid(self.slope * self.raw_scores(buckets, first) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Learner:
    """A model with the state of its adaptive gradient steps."""

    def __init__(self, seed: int = 7):
        self.model = Model.new(seed)
        self.squares = [np.full(p.shape, 0.1, np.float32) for p in self.parts()]
        self.square_e = np.full(BUCKETS, 0.1, np.float32)
        self.square_o = 0.1

    def parts(self) -> list[np.ndarray]:
        return [*self.model.filters, *self.model.bias, self.model.weight]

    def dense(self) -> np.ndarray:
        """All but the embedding."""
        flat = [p.ravel() for p in [*self.parts(), *self.squares]]
        return np.concatenate([*flat, [self.model.offset, self.square_o]]).astype(float)

    def sparse(self) -> np.ndarray:
        """A row for each bucket."""
        return np.column_stack([self.model.embedding, self.square_e]).astype(float)

    def change(self, dense: np.ndarray, sparse: np.ndarray) -> None:
        """Add what :meth:`dense` and :meth:`sparse` are to change by."""
        at = 0
        for part in [*self.parts(), *self.squares]:
            part += dense[at : at + part.size].reshape(part.shape)
            at += part.size
        self.model.offset += float(dense[at])
        self.square_o += float(dense[at + 1])
        self.model.embedding += sparse[:, :DIM]
        self.square_e += sparse[:, DIM]

    def fit(self, texts: list[np.ndarray], toxic: np.ndarray, cost: np.ndarray, epochs: int, rng) -> np.ndarray:
        """Fit on texts given as arrays of buckets, by adaptive gradient steps on small batches.

        The maximum passes its gradient to one window per filter, so a step touches few
        embeddings.  Returns the number of steps that touched each.
        """
        model, parts, total = self.model, self.parts(), len(texts)
        touches = np.zeros(BUCKETS, np.int64)
        rate, sizes = 0.12, np.array([len(t) for t in texts])
        for _ in range(epochs):
            order, at = rng.permutation(total), 0
            while at < total:
                chosen = order[at : at + BATCH]
                chosen = chosen[: max(1, int(np.searchsorted(np.cumsum(sizes[chosen]), BATCH_WORDS, "right")))]
                at += len(chosen)
                buckets = np.concatenate([texts[i] for i in chosen])
                first = np.r_[0, np.cumsum(sizes[chosen])]
                pooled, where = model.pool(buckets, first, places=True)
                error = (_sigmoid(pooled @ model.weight + model.offset) - toxic[chosen]) * cost[chosen] / len(chosen)
                error = error.astype(np.float32)
                grads = [np.zeros_like(p) for p in parts]
                grads[-1] = pooled.T @ error + 1e-4 * model.weight
                back = error[:, None] * model.weight  # to each pooled value
                touched, changes = [], []
                for k, width in enumerate(WIDTHS):
                    for f in range(FILTERS):
                        column = k * FILTERS + f
                        hit = np.flatnonzero(where[:, column] >= 0)
                        if not len(hit):
                            continue
                        g = back[hit, column]
                        grads[len(WIDTHS) + k][f] = g.sum()
                        for j in range(width):
                            rows = buckets[where[hit, column] + j]
                            grads[k][j, :, f] = g @ model.embedding[rows].sum(1)
                            touched.append(rows.ravel())
                            changes.append(np.repeat(g, PARTS)[:, None] * model.filters[k][j, :, f])
                for part, square, grad in zip(parts, self.squares, grads):
                    square += grad * grad
                    part -= rate * grad / np.sqrt(square)
                self.square_o += float(error.sum()) ** 2
                model.offset -= rate * float(error.sum()) / self.square_o**0.5
                if touched:
                    rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                    change = np.zeros((len(rows), DIM), np.float32)
                    np.add.at(change, inverse, np.concatenate(changes))
                    self.square_e[rows] += (change * change).mean(1)
                    model.embedding[rows] -= rate * change / np.sqrt(self.square_e[rows])[:, None]
                    touches[rows] += 1
        return touches


def _portions(batches: Iterator[pa.RecordBatch], max_rows: int, max_words: int):
    """``shard, texts, toxic`` for stretches of rows of one shard, of a bounded size.

    The columns are ``text, toxic, shard``; texts are given as arrays of buckets.
    """
    current, texts, toxic, held = None, [], [], 0
    for batch in batches:
        for text, label, shard in slices(*batch.columns):
            buckets, first = word_buckets(text)
            for a, b, y, s in zip(first[:-1].tolist(), first[1:].tolist(), label.to_pylist(), shard.to_pylist()):
                if texts and (s != current or len(texts) >= max_rows or held + b - a > max_words):
                    yield current, texts, np.array(toxic)
                    texts, toxic, held = [], [], 0
                current = s
                texts.append(buckets[a:b])
                toxic.append(y)
                held += b - a
    if texts:
        yield current, texts, np.array(toxic)


def _round(rows: DataFrame, learner: Learner, number: int, share: float, max_rows: int, max_words: int) -> None:
    """Fit ``learner`` further: on each portion from the same start, then all changes averaged.

    A bucket's embedding is averaged over the portions by the steps that touched it, all else
    by rows.  A task adds up its portions, so what moves is one model for each task.
    """
    shared = rows.sparkSession.sparkContext.broadcast(learner)  # of a fixed size

    def run(batches):
        start = shared.value
        dense, sparse = start.dense(), start.sparse()
        sums, origin = None, None
        for shard, texts, toxic in _portions(batches, max_rows, max_words):
            own = copy.deepcopy(start)
            cost = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
            touches = own.fit(texts, toxic, cost, ROUNDS[number], np.random.default_rng([7, number, shard]))
            if sums is None:
                sums, origin = [np.zeros(1 + len(dense)), np.zeros((BUCKETS, 1 + sparse.shape[1]))], shard
            sums[0] += np.r_[1, own.dense() - dense] * len(toxic)
            sums[1] += np.column_stack([np.ones(BUCKETS), own.sparse() - sparse]) * touches[:, None]
        if sums is not None:
            data = [s.astype(np.float32).tobytes() for s in (sums[0], *np.split(sums[1], MODEL_BLOCKS))]
            blocks = pa.array(range(-1, MODEL_BLOCKS), pa.int32())
            origins = pa.array([origin] * len(data), pa.int64())
            yield pa.RecordBatch.from_arrays([blocks, origins, pa.array(data, pa.binary())], ["block", "origin", "data"])

    def add(block: pa.Table) -> pa.Table:
        block = block.sort_by([("origin", "ascending"), ("data", "ascending")])  # the same sum each time
        total = sum(np.frombuffer(d.as_buffer(), np.float32).astype(float) for d in block.column("data"))
        return pa.table({"block": block.column("block")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    changed = rows.select("text", "toxic", "shard").mapInArrow(run, "block int, origin bigint, data binary")
    totals = changed.groupBy("block").applyInArrow(add, "block int, data binary").collect()  # one model
    dense, *sparse = [np.frombuffer(r["data"]) for r in sorted(totals, key=lambda r: r["block"])]
    sparse = np.concatenate(sparse).reshape(BUCKETS, -1)
    learner.change(dense[1:] / dense[0], sparse[:, 1:] / np.maximum(1, sparse[:, :1]))


def calibrate(model: Model, rows: DataFrame) -> None:
    """Set slope, shift and thresholds from rows ``text, lang, toxic``, all of them.

    The likelihood is summed by Spark for each step of Newton's method.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(batch):
            for texts, lang, toxic in slices(*batch.columns):
                yield [lang, toxic, pa.array(shared.value.raw_scores(*word_buckets(texts)), pa.float64())]

        return step

    judged = rows.select("text", F.coalesce("lang", F.lit("")).alias("lang"), "toxic")
    judged = materialize(map_batches(judged, make, "lang string, toxic int, logit double"))
    scale = max(1.0, judged.agg(F.avg(F.abs("logit"))).first()[0])
    x, target = F.col("logit") / scale, F.when(F.col("toxic") == 1, 0.98).otherwise(0.02)

    def likelihood(slope: float, shift: float) -> np.ndarray:
        """Mean loss, its two slopes and its three curvatures."""
        z = slope * x + shift
        p, soft = 1 / (1 + F.exp(-z)), F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        error, bend = p - target, p * (1 - p)
        return np.array(judged.agg(*map(F.avg, (soft - target * z, error * x, error, bend * x * x, bend * x, bend))).first())

    at = np.array([1.0, 0.0])
    here = likelihood(*at)
    for _ in range(50):
        loss, g, g_shift, h, h_both, h_shift = here
        if at[0] <= 0.05 and g > 0:  # the slope stays at its least
            move = np.array([0.0, -g_shift / max(h_shift, 1e-9)])
        else:
            move = -np.linalg.solve([[h + 1e-9, h_both], [h_both, h_shift + 1e-9]], [g, g_shift])
        for _ in range(30):
            to = np.array([max(0.05, at[0] + move[0]), at[1] + move[1]])
            there = likelihood(*to)
            if there[0] <= loss:
                break
            move /= 2
        else:
            break
        done = np.abs(to - at).max() < 1e-6
        at, here = to, there
        if done:
            break
    model.slope, model.shift = float(at[0]) / scale, float(at[1])
    score = 1 / (1 + F.exp(-(model.slope * F.col("logit") + model.shift)))
    steps = np.linspace(0.2, 0.8, 25)
    wrong = [F.sum(((score >= t) != (F.col("toxic") == 1)).cast("int")).alias(f"wrong_{i}") for i, t in enumerate(steps.tolist())]
    langs = judged.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("n_toxic"), *wrong)
    # of others there are too few to tell: the threshold of all languages holds
    for row in langs.where("n >= 20 and n_toxic >= 5 and n_toxic < n").collect():
        counts = np.array([row[f"wrong_{i}"] for i in range(len(steps))])
        best = np.flatnonzero(counts == counts.min())
        model.thresholds[row["lang"]] = float(steps[best[np.abs(steps[best] - 0.5).argmin()]])


def train(
    docs: DataFrame, labels: DataFrame, portion_rows: int = PORTION_ROWS, portion_words: int = PORTION_WORDS
) -> Model:
    """A model from all labelled rows (``doc_id, toxic``), which must not include held-out ones.

    One in five, by a hash, is kept out of the fit and calibrates the score.  Labels that are
    null are left out; of several for one document the largest counts.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = materialize(known.select("doc_id", "toxic", F.xxhash64("doc_id", F.lit(5)).alias("place")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return _constant(next(iter(counts), 0))
    shards = -(-sum(counts.values()) // portion_rows)
    texts = docs.select("doc_id", "text", F.col("lang").cast("string"))
    if docs.schema["doc_id"].dataType == labels.schema["doc_id"].dataType:  # texts without a label need not move
        texts = BloomFilter.build(known, "doc_id").keep(texts, F.col("doc_id"))
    rows = _portioned(texts, known, shards)
    counts = {(r["toxic"], r["aside"]): r["count"] for r in rows.groupBy("toxic", "aside").count().collect()}
    kinds = {toxic for toxic, _ in counts}
    if len(kinds) < 2:
        return _constant(next(iter(kinds), 0))
    apart = min(counts.get((toxic, True), 0) for toxic in (0, 1)) >= 10
    fitted = {t: counts.get((t, False), 0) + (0 if apart else counts.get((t, True), 0)) for t in (0, 1)}
    share = float(np.clip(fitted[1] / sum(fitted.values()), 0.02, 0.98))
    learner = Learner()
    for number in range(len(ROUNDS)):
        _round(rows.where("not aside") if apart else rows, learner, number, share, portion_rows, portion_words)
    calibrate(learner.model, rows.where("aside") if apart else rows)
    return learner.model


def _portioned(texts: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """Labelled texts, written, all rows of a ``shard`` in one partition.

    Texts and labels are dealt together by document, a partition for each shard, and meet there.  A
    join would deal both anew where there are more shuffle partitions, and each of them would
    hold a small part of every shard; dealing its result again would move the texts twice.
    """
    labels = known.select("doc_id", F.struct("toxic", "place").alias("known"))
    dealt = texts.where("doc_id is not null").withColumn("is_text", F.lit(True)).unionByName(labels.withColumn("is_text", F.lit(False)), allowMissingColumns=True)
    met = dealt.repartition(shards, "doc_id").withColumn("known", F.max("known").over(Window.partitionBy("doc_id")))
    rows = met.where("is_text and known is not null").select(
        F.coalesce("text", F.lit("")).alias("text"), "lang", "known.toxic", "known.place",
        (F.pmod("known.place", F.lit(5)) == 4).alias("aside"), F.pmod(F.hash("doc_id"), F.lit(shards)).cast("long").alias("shard"),
    )
    return materialize(rows.sortWithinPartitions("shard", "place", "text"))


def _constant(score: float) -> Model:
    model = Model.new()
    model.prior = float(score)
    return model


def score_toxicity(
    docs: DataFrame, model: Model, keep: list[str], text: str = "text", score: str = "score"
) -> DataFrame:
    """Columns ``keep`` and ``score`` (0 to 1) of each row; null texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    names = [f"__{i}" for i in range(len(keep))]
    inputs = docs.select(F.coalesce(text, F.lit("")), *(F.col(c).alias(n) for c, n in zip(keep, names)))
    kinds = [f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names)]

    def make():
        def step(batch):
            for texts, *others in slices(*batch.columns):
                yield [*others, pa.array(shared.value.scores(*word_buckets(texts)), pa.float64())]

        return step

    scored = map_batches(inputs, make, ", ".join([*kinds, "score double"]))
    return scored.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), F.col("score").alias(score))


def toxic_by_language(score: str, lang: str, model: Model):
    """True where the score reaches the threshold of the language, 0.5 where it has none."""
    threshold = F.lit(0.5)
    for name, value in model.thresholds.items():
        threshold = F.when(F.col(lang) == name, F.lit(value)).otherwise(threshold)
    return F.col(score) >= threshold
