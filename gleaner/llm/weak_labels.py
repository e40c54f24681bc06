"""Quality classifier from weak labels.

Heuristic labellers vote good (1), bad (0) or abstain (null) on every whole text. Texts with the same votes form a
pattern; there are at most 3 ** (number of labellers) patterns, whatever the input, and their counts over all documents
are all that expectation-maximisation needs: it estimates the share of good text and each labeller's accuracy on good
and on bad text, and gives each pattern its posterior. The posteriors are the labels of a linear scorer over hashed words
and shape features, trained by gradient steps on at most `fit_rows` different texts (a documented bound, the first by a
hash of the text; each text once, so that one that is repeated often can't crowd out others); Spark sums the gradients.
The votes are worked out once and stored with the rows. Every document is scored whole.

Defined results: null and empty texts have no words, on which most labellers vote bad; a text of any length is read whole;
repeated rows score alike; where all labellers abstain the posterior is the share of good text. Input columns stay
whatever their names, but those named as a new column are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANKS, stored, word_count

FIT_ROWS = 20_000
BUCKETS = 1 << 14
STEPS = 25
RATE = 2.0
RIDGE = 1e-4
THRESHOLD = 0.5

FREQUENT = r"(?i)(?<![^\x20\x09-\x0D])(the|of|and|to|in|is|that|le|la|les|de|des|et|un|une|que|der|die|das|und|ist|von|mit|den|el|los|las|y|en|una|por|con|a|it|was)(?![^\x20\x09-\x0D])"


def labellers(text: Column) -> dict[str, Column]:
    """Votes by name: 1 good, 0 bad, null none."""
    body = F.coalesce(text, F.lit(""))
    n = word_count(text)
    chars = F.length(F.regexp_replace(body, BLANKS, ""))
    mean = chars / F.greatest(n, F.lit(1))
    share = lambda pattern: F.regexp_count(body, F.lit(pattern)) / F.greatest(chars, F.lit(1))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.trim(x)) > 0)
    distinct = F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))
    frequent = F.regexp_count(body, F.lit(FREQUENT)) / F.greatest(n, F.lit(1))
    vote = lambda good, bad: F.when(bad, 0).when(good, 1)
    return {
        "length": vote((n >= 50) & (n <= 50_000), n < 10),
        "mean_word": vote((mean >= 3.5) & (mean <= 8), (mean < 2.5) | (mean > 14)),
        "symbols": vote(share(r"[#*$%&|<>]") < 0.005, share(r"[#*$%&|<>]") > 0.04),
        "lines": vote(distinct > 0.95, distinct < 0.6),
        "frequent_words": vote(frequent > 0.12, frequent < 0.03),
        "digits": vote(share(r"[0-9]") < 0.02, share(r"[0-9]") > 0.2),
        "sentences": vote(share(r"[.!?]") > 0.005, share(r"[.!?]") == 0),
        "capitals": vote(share(r"\p{Lu}") < 0.1, share(r"\p{Lu}") > 0.4),
    }


@dataclass
class LabelModel:
    """Share of good text and P(vote = 1 | good), P(vote = 1 | bad) of each labeller."""

    good: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(good) of each row of votes; nan abstains."""
        odds = np.full(len(votes), np.log(self.good / (1 - self.good)))
        for k in range(votes.shape[1]):
            v = votes[:, k]
            odds += np.where(v == 1, np.log(self.on_good[k] / self.on_bad[k]), 0) + np.where(v == 0, np.log((1 - self.on_good[k]) / (1 - self.on_bad[k])), 0)
        return 1 / (1 + np.exp(-odds))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns, from labellers that are taken to be right more often than not."""
    k = votes.shape[1]
    model = LabelModel(0.7, np.full(k, 0.8), np.full(k, 0.3))
    voted = ~np.isnan(votes)
    ones = np.where(voted, votes, 0)
    for _ in range(rounds):
        p = model.posterior(votes)
        w, u = counts * p, counts * (1 - p)
        on_good = (w @ ones + 4) / (w @ voted + 5)
        on_bad = (u @ ones + 1) / (u @ voted + 5)
        good = float(np.clip((w.sum() + 1) / (counts.sum() + 2), 0.02, 0.98))
        step = max(np.abs(on_good - model.on_good).max(initial=0), np.abs(on_bad - model.on_bad).max(initial=0))
        model = LabelModel(good, np.clip(on_good, 0.01, 0.99), np.clip(on_bad, 0.01, 0.99))
        if step < 1e-6:
            break
    return model


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value) of a text: log-damped counts of hashed words and word shapes, of unit length, and a constant."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.array([0]), np.array([1.0])
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    slot = np.array([xxhash.xxh3_64_intdigest(w) % (BUCKETS - 64) + 64 for w in counts])
    n = np.fromiter(counts.values(), dtype=float)
    shape = np.array([1 + min(len(w), 24) if w[:1].isalpha() or w[0] > 127 else 30 + min(len(w), 24) for w in counts])
    value = np.bincount(np.concatenate((slot, shape)), weights=np.concatenate((np.log1p(n), np.log1p(n))))
    at = np.flatnonzero(value)
    value = value[at] / np.sqrt((value[at] ** 2).sum())
    return np.concatenate(([0], at)), np.concatenate(([1.0], value))


def train_scorer(training: DataFrame) -> np.ndarray:
    """Weights of the buckets, from stored (text, posterior) rows: gradient steps with sums over partitions by Spark."""
    spark = training.sparkSession

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0].tolist() for g in got], pa.list_(pa.int32())), pa.array([g[1].tolist() for g in got], pa.list_(pa.float32())), batch.column("posterior")], names=["at", "value", "y"]
            )

    rows = stored(training.mapInArrow(featurise, "at array<int>, value array<float>, y double"), "weak-features")
    n = rows.count()
    weights, speed = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for _ in range(STEPS if n else 0):
        shared = spark.sparkContext.broadcast(weights)

        def gradient(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total, w = np.zeros(BUCKETS), shared.value
            for batch in batches:
                at, value = batch.column("at"), batch.column("value")
                flat, x, ends = at.flatten().to_numpy(), value.flatten().to_numpy().astype(float), np.cumsum(at.value_lengths().to_numpy())
                if not len(ends):
                    continue
                row = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
                z = np.bincount(row, weights=x * w[flat], minlength=len(ends))
                error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - batch.column("y").to_numpy()
                total += np.bincount(flat, weights=x * error[row], minlength=BUCKETS)
            live = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(live.astype(np.int32)), pa.array(total[live])], names=["at", "g"])

        found = rows.mapInArrow(gradient, "at int, g double").groupBy("at").agg(F.sum("g").alias("g")).toPandas()  # BUCKETS rows at most
        g = RIDGE * weights
        g[found["at"]] += found["g"].to_numpy() / n
        speed = 0.8 * speed - RATE * 8 * g
        weights = weights + speed
        shared.unpersist()
    return weights


def classify(docs: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """docs with n_votes, posterior (of the label model), score (of the linear scorer) and good (score >= THRESHOLD)."""
    spark, names = docs.sparkSession, list(labellers(F.lit("")))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    code = F.lit(0)
    for c in labellers(F.col("_text")).values():
        code = code * 3 + F.coalesce(c, F.lit(2))
    clean = [c for c in docs.columns if c not in ("n_votes", "posterior", "score", "good")]
    row = F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in clean] or [F.lit(None).alias("none")])
    voted = stored(packed.select(row.alias("_row"), "_text", code.cast("int").alias("_pattern"), F.xxhash64("_text", F.lit(7)).alias("_hash")), "weak-votes")
    counts = voted.groupBy("_pattern").count().toPandas()  # 3 ** labellers rows at most
    patterns = np.arange(3 ** len(names))
    digits = np.stack([patterns // 3 ** (len(names) - 1 - k) % 3 for k in range(len(names))], axis=1).astype(float)
    votes = np.where(digits == 2, np.nan, digits)
    weight = np.zeros(len(patterns))
    weight[counts["_pattern"]] = counts["count"]
    seen = weight > 0
    model = fit_label_model(votes[seen], weight[seen])
    posterior = model.posterior(votes)
    n_votes = (~np.isnan(votes)).sum(axis=1)
    lookup = F.broadcast(spark.createDataFrame([(int(p), float(posterior[p]), int(n_votes[p])) for p in patterns[seen]] or [(-1, 0.0, 0)], "_pattern int, posterior double, n_votes int"))
    drawn = voted.select("_hash").distinct().orderBy("_hash").limit(fit_rows).agg(F.max("_hash")).first()[0]
    sample = voted.where(F.col("_hash") <= F.lit(drawn)).groupBy("_hash").agg(F.first("_text").alias("text"), F.first("_pattern").alias("_pattern"))
    weights = spark.sparkContext.broadcast(train_scorer(sample.join(lookup, "_pattern").select("text", "posterior")))
    joined = voted.join(lookup, "_pattern").select("_row", "_text", "n_votes", "posterior")
    kept = ["_row", "n_votes", "posterior"]
    schema = T.StructType([joined.schema[c] for c in kept] + [T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [float(v @ weights.value[at]) for at, v in (features(t.as_py()) for t in batch.column("_text"))]
            out = pa.array(1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -40, 40))), type=pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], out], names=[*kept, "score"])

    return joined.mapInArrow(score, schema).select(*[F.col(f"_row.`{c}`").alias(c) for c in clean], "n_votes", "posterior", "score", (F.col("score") >= THRESHOLD).alias("good"))
