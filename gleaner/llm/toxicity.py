"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary text, are counted from labelled documents; every word and bigram
counts. Both discount their counts (by the counts of counts) and back off: bigrams to bigrams pooled over both classes,
then to the class's continuation counts (in how many different contexts a word follows), and those to continuation counts
pooled over both classes. After a context both classes leave the same mass to the backoff, the larger of what either
would leave. So a rare expression costs either model about the same.
A text is measured by the length-normalised difference of its two log-likelihoods, over the whole text and over its
most toxic stretch of 1, 2 and 4 words, and by its most toxic word out of context (continuation probabilities alone). A
logistic curve over these five numbers is the score; the threshold 0.3
is put where F1 is best. Curve and threshold come from documents that the scoring model had not counted (two halves,
each scored by the other half's model).

The models are fitted on at most `fit_toxic` + `fit_ordinary` labelled documents, the first by a hash of the id (a
documented bound, so that the counts may be broadcast); every document is scored whole. Labels enter the fit alone.
Words are numbered, and what is shuffled, collected and broadcast are packed counts of pairs of numbers; workers build
the models they need from them.

Defined results: a null or empty text has all measures 0; a text of any length is measured whole; labels that are null
are ignored, a document labelled both ways counts as toxic; repeated rows score alike; without labelled documents of both
classes every score is 0. Input columns stay whatever their names; one named as the score is replaced (drop_toxic replaces
none). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, give_back, pack, pack_sorted, stored, unpack, unpack_sorted

FIT_TOXIC, FIT_ORDINARY = 4000, 12000
DISCOUNT = 0.75
SPANS = (1, 2, 4)
THRESHOLD = 0.3
HELD_OUT_FOLD, FOLDS = 2, 4
START = b""
COUNTS = ("a0", "a1", "b0", "b1")  # half of the sample, class


def split_words(text: str | None) -> list[bytes]:
    """Words, with A-Z lower-cased; bytes.split and bytes.lower know ASCII blanks and letters alone."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def pick_training(docs: DataFrame, labels: DataFrame, fit_toxic: int = FIT_TOXIC, fit_ordinary: int = FIT_ORDINARY) -> DataFrame:
    """(text, toxic, half) of the documents to fit on."""
    labelled = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = labelled.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD)
    h = F.xxhash64("doc_id")
    picked = [labelled.where(F.col("toxic") == y).select("doc_id", "toxic", h.alias("h")).orderBy("h").limit(n) for y, n in ((1, fit_toxic), (0, fit_ordinary))]
    ids = picked[0].unionByName(picked[1]).withColumn("half", F.pmod(F.shiftright("h", 7), F.lit(2)).cast("int"))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"), "half")


@dataclass
class Counts:
    """Every word of the sample, START first, and how often word w follows word v in each half and class, packed."""

    words: list[bytes]
    packed: list[tuple[bytes, bytes, int]]  # keys, counts, how many

    def pairs(self, halves: str) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) of the pairs that some halves hold: v * (V + 1) + w, sorted, and a row of counts for each class. Unpacked
        piece by piece, so that no more than the result is held."""
        most, held = sum(size for _, _, size in self.packed), 0
        keys, counts = np.empty(most, dtype=np.int64), np.empty((2, most), dtype=np.int32)
        for k, n, _ in self.packed:
            every = unpack(n).reshape(4, -1).astype(np.int32)
            some = np.stack([sum(every[COUNTS.index(f"{h}{c}")] for h in halves) for c in (0, 1)])
            seen = some.any(axis=0)
            to = held + np.count_nonzero(seen)
            keys[held:to], counts[:, held:to], held = unpack_sorted(k)[seen], some[:, seen], to
        return keys[:held], counts[:, :held]

    def model(self, halves: str) -> KneserNey | None:
        """The model of some halves, built once in each worker."""
        built = self.__dict__.setdefault("_built", {})
        if halves not in built:
            built[halves] = build_model(self, halves)
            give_back()
        return built[halves]

    def __getstate__(self) -> dict:
        return {"words": self.words, "packed": self.packed}


def count_bigrams(training: DataFrame) -> Counts:
    """Counts of the stored training documents. Their size is bounded by the sample."""
    spark = training.sparkSession

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[bytes] = set()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(split_words(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], names=["w"])

    rows = training.select("text").mapInArrow(distinct_words, "w binary").distinct().toArrow()
    words = [START, *sorted(rows.column("w").to_pylist())]
    size = len(words) + 1
    listing = spark.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(listing.value)}
        for batch in batches:
            keys: list[list[np.ndarray]] = [[] for _ in COUNTS]
            for text, y, half in zip(*[batch.column(c).to_pylist() for c in ("text", "toxic", "half")], strict=True):
                w = np.array([0, *(number[x] for x in split_words(text))], dtype=np.int64)
                keys[2 * half + y].append(w[:-1] * size + w[1:])
            for k, some in enumerate(keys):
                if some:
                    key, n = np.unique(np.concatenate(some), return_counts=True)
                    zero = np.zeros(len(key), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key), *[pa.array(n.astype(np.int32) if j == k else zero) for j in range(4)]], names=["key", *COUNTS])

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.concatenate([batch.column(c).to_numpy() for c in COUNTS])
            yield pa.RecordBatch.from_arrays([pa.array([pack_sorted(batch.column("key").to_numpy())], pa.binary()), pa.array([pack(counts)], pa.binary()), pa.array([batch.num_rows], pa.int64())], names=["keys", "counts", "n"])

    counted = training.mapInArrow(count, "key long, " + ", ".join(f"{c} int" for c in COUNTS)).groupBy("key").agg(*[F.sum(c).alias(c) for c in COUNTS])
    rows = counted.orderBy("key").mapInArrow(packs, "keys binary, counts binary, n long").collect()  # in order of key
    return Counts(words, [(bytes(r["keys"]), bytes(r["counts"]), r["n"]) for r in rows])


@dataclass
class KneserNey:
    """Both class models over one word list; arrays by word number, the last number stands for unlisted words."""

    words: dict[bytes, int]
    p: np.ndarray  # (2, V + 1) continuation probabilities
    total: np.ndarray  # (2, V + 1) tokens after a context
    rest: np.ndarray  # (2, V + 1) mass that a context leaves to the backoff
    pairs: np.ndarray  # sorted v * (V + 1) + w
    counts: np.ndarray  # (2, pairs); discounts are taken where a count is looked up
    less: np.ndarray  # (3, 4) discounts of the counts 0, 1, 2 and more: of each class, and of both together
    pool_total: np.ndarray  # (V + 1) as total and rest, of both classes together
    pool_rest: np.ndarray

    @property
    def kept(self) -> np.ndarray:
        """(2, pairs) discounted counts of the classes."""
        return np.stack([discounted(n, less) for n, less in zip(self.counts, self.less, strict=False)])

    @property
    def pool(self) -> np.ndarray:
        """(pairs) discounted counts of both classes together."""
        return discounted(self.counts.sum(axis=0), self.less[2])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get, unlisted = self.words.get, len(self.words)
        return np.array([get(w, unlisted) for w in words], dtype=np.int64)

    def ratios(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log p(w | v, toxic) - log p(w | v, ordinary) of each token; `first` marks the first token of a text."""
        size = self.p.shape[1]
        before = np.concatenate(([size - 1], number[:-1])) if len(number) else number
        before = np.where(first, self.words[START], before)
        key = before * size + number
        at = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
        hit = self.pairs[at] == key if len(self.pairs) else np.zeros(len(key), dtype=bool)
        found = np.where(hit, self.counts[:, at], 0) if len(self.pairs) else np.zeros((2, len(key)), dtype=np.int32)
        of = lambda n, less: (n - less[np.minimum(n, 3)]).astype(np.float32)
        pooled, left = of(found.sum(axis=0), self.less[2]) / np.maximum(self.pool_total[before], 1), np.where(self.pool_total[before] > 0, self.pool_rest[before], 1.0)
        rest = [np.where(self.total[c][before] > 0, self.rest[c][before], 1.0) for c in (0, 1)]
        shared = np.maximum(*rest)
        both = []
        for c in (0, 1):
            own = 1 - rest[c]
            seen = of(found[c], self.less[c]) / np.maximum(self.total[c][before], 1) / np.where(own > 0, own, 1)
            both.append((1 - shared) * seen + shared * (pooled + left * self.p[c][number]))
        return np.log(both[1]) - np.log(both[0])


def discounts(counts: np.ndarray) -> np.ndarray:
    """The discounts of modified Kneser-Ney for the counts 0, 1, 2 and more; DISCOUNT where the counts of counts don't tell."""
    of = np.array([np.count_nonzero(counts == k) for k in range(5)], dtype=float)
    less = np.array([0, DISCOUNT, DISCOUNT, DISCOUNT], dtype=np.float32)
    if of[1:5].all():
        y = of[1] / (of[1] + 2 * of[2])
        less[1:] = [np.clip(k - (k + 1) * y * of[k + 1] / of[k], 0.1, k) for k in (1, 2, 3)]
    return less


def discounted(counts: np.ndarray, less: np.ndarray | None = None) -> np.ndarray:
    """Counts less their discounts, in single precision."""
    less = discounts(counts) if less is None else less
    out = counts.astype(np.float32)
    for k in (1, 2, 3):
        out[(counts == k) if k < 3 else (counts >= k)] -= less[k]
    return out


def build_model(counted: Counts, halves: str) -> KneserNey | None:
    """A model of the counts of `halves` ('a', 'b' or 'ab'). None if a class has no words."""
    size = len(counted.words) + 1
    key, counts = counted.pairs(halves)
    w = np.empty(len(key), dtype=np.int32)
    np.remainder(key, size, out=w, casting="unsafe")
    n = np.stack([np.bincount(w[counts[c] > 0], minlength=size)[:-1] for c in (0, 1)]).astype(float)
    if not (n.sum(axis=1) > 0).all():
        return None
    pooled = n.sum(axis=0)
    back = np.append(discounted(pooled).astype(float) / pooled.sum(), 0.0)
    back += (1 - back.sum()) / size
    p = np.zeros((2, size))
    for c in (0, 1):
        own = np.append(discounted(n[c]).astype(float) / n[c].sum(), 0.0)
        p[c] = own + (1 - own.sum()) * back
    v = w  # its memory again
    np.floor_divide(key, size, out=v, casting="unsafe")
    begins = np.flatnonzero(np.diff(v, prepend=np.int32(-1)))
    contexts = v[begins]
    del v, w

    def by_context(x: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        out[contexts] = np.add.reduceat(x, begins, dtype=np.float64)
        return out

    total = np.stack([by_context(counts[c]) for c in (0, 1)])
    less = np.zeros((3, 4), dtype=np.float32)
    rest = np.zeros((2, size))
    for c in (0, 1):
        less[c] = discounts(counts[c])
        rest[c] = 1 - by_context(discounted(counts[c], less[c])) / np.maximum(total[c], 1)
    both, pool_total = counts.sum(axis=0, dtype=np.int32), total.sum(axis=0)
    less[2] = discounts(both)
    pool_rest = 1 - by_context(discounted(both, less[2])) / np.maximum(pool_total, 1)
    return KneserNey({x: i for i, x in enumerate(counted.words)}, p, total, rest, key, counts, less, pool_total, pool_rest)


def measures(model: KneserNey, texts: list[str | None]) -> np.ndarray:
    """(texts, 5): best mean ratio over stretches of SPANS words, best of a word out of context, and the mean over the text."""
    split = [split_words(t) for t in texts]
    sizes = np.array([len(x) for x in split], dtype=np.int64)
    out = np.zeros((len(texts), len(SPANS) + 2))
    live = np.flatnonzero(sizes > 0)
    if not len(live):
        return out
    begins = np.cumsum(sizes[live]) - sizes[live]
    number = model.numbers([w for x in split for w in x])
    first = np.zeros(len(number), dtype=bool)
    first[begins] = True
    x = model.ratios(number, first)
    sums = np.concatenate(([0.0], np.cumsum(x)))
    ends = begins + sizes[live]
    text_end = np.repeat(ends, sizes[live])
    at = np.arange(len(x))
    for j, k in enumerate(SPANS):
        stop = np.minimum(at + k, text_end)
        mean = (sums[stop] - sums[at]) / k
        short = np.repeat(sizes[live] < k, sizes[live])
        mean = np.where((at + k <= text_end) | (short & (at == np.repeat(begins, sizes[live]))), mean, -np.inf)
        out[live, j] = np.maximum.reduceat(mean, begins)
    out[live, -2] = np.maximum.reduceat(np.log(model.p[1][number]) - np.log(model.p[0][number]), begins)
    out[live, -1] = (sums[ends] - sums[begins]) / sizes[live]
    return out


@dataclass
class Curve:
    """Logistic over standardised measures, shifted so that THRESHOLD is where F1 is best."""

    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.hstack([(x - self.middle) / self.scale, np.ones((len(x), 1))]) @ self.weights + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_curve(x: np.ndarray, y: np.ndarray) -> Curve:
    curve = Curve(x.mean(axis=0), x.std(axis=0) + 1e-9, np.zeros(x.shape[1] + 1))
    a = np.hstack([(x - curve.middle) / curve.scale, np.ones((len(x), 1))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ curve.weights, -40, 40)))
        curve.weights += np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 0.1 * np.eye(a.shape[1]), a.T @ (y - p) - 0.1 * curve.weights)
    z = a @ curve.weights
    order = np.argsort(-z)
    hits, taken = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    k = int(np.argmax(2 * hits / (taken + y.sum())))
    cut = z[order[k]] if k + 1 >= len(z) else (z[order[k]] + z[order[k + 1]]) / 2
    curve.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)
    return curve


def fit(docs: DataFrame, labels: DataFrame, fit_toxic: int = FIT_TOXIC, fit_ordinary: int = FIT_ORDINARY) -> tuple[Counts, Curve] | None:
    """Counts and curve; None where the labels do not show both classes in both halves."""
    training = stored(pick_training(docs, labels, fit_toxic, fit_ordinary), "tox-training")
    shared = docs.sparkSession.sparkContext.broadcast(count_bigrams(training))

    def measured(half: int) -> pd.DataFrame:
        """Measures of one half by the model of the other; one model at a time is held, and none beyond its task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unseen = build_model(shared.value, "ba"[half])
            for batch in batches:
                if unseen is not None and batch.num_rows:
                    x = measures(unseen, batch.column("text").to_pylist())
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T] + [batch.column("toxic").cast(pa.int64())], names=["m0", "m1", "m2", "m3", "m4", "y"])
            del unseen
            give_back()

        return training.where(F.col("half") == half).select("text", "toxic").mapInArrow(run, "m0 double, m1 double, m2 double, m3 double, m4 double, y long").toPandas()

    seen = pd.concat([measured(0), measured(1)], ignore_index=True)
    y = seen.pop("y").to_numpy(dtype=float)
    return (shared.value, fit_curve(seen.to_numpy(), y)) if len(set(y)) == 2 else None


def score_documents(docs: DataFrame, fitted: tuple[Counts, Curve] | None, text: str = "text", score: str = "score") -> DataFrame:
    """docs with a double column `score` (replaces one of that name)."""
    names = [c for c in docs.columns if c != score]
    own = [F.col(f"`{c}`") for c in names]
    if fitted is None:
        return docs.select(*own, F.lit(0.0).alias(score))
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counted, curve = shared.value
        model = counted.model("ab")
        for batch in batches:
            got = [np.zeros(0)]
            for begin in range(0, len(batch), 1000):
                got.append(curve.score(measures(model, batch.slice(begin, 1000).to_pylist())))
            yield pa.array(np.concatenate(got))

    # Only texts go to the workers; the other columns stay where they are.
    return docs.select(*own, F.arrow_udf(run, "double")(F.col(f"`{text}`")).alias(score))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with the columns they came with."""
    fitted = fit(docs, labels)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    return score_documents(packed, fitted, "_text", "_score").where(F.col("_score") < THRESHOLD).select("_row.*")
