"""Importance resampling towards a target distribution: hashed features, Gumbel noise, and an exact draw of the top scores.

Words are lower-cased (A-Z) runs of letters, digits and characters beyond ASCII; features are runs of 1 to `longest` words,
hashed into buckets. All documents and all target texts are counted; the log ratio of a bucket is its gain, and a document's
weight is the sum of the gains of its features. Gumbel noise from a seeded digest of the id turns the highest scores
into a weighted draw without replacement.

The draw is exact and distributed. Cut keys from a bounded sample split the order of (score, id, row) into ranges, which
are counted; ranges beyond the draw are left alone. Tasks sort their eligible rows and write the runs as packed slices, one
for each range they meet; a task for each range merges its slices through tournament trees of `FAN` leaves (a tree of
trees where there are more), gives out ranks from the counts of the ranges before, and stops at the exact draw
count. The row number makes keys differ, so ranges stay even where a third of the rows share a score and an id. No text is
shuffled; the driver holds one count a bucket, one a range, and at most `SAMPLE` keys.

Defined results: a null or empty text has no features, weight 0, and is not eligible below `least` words. A text of any length is
counted whole. A null id counts as the empty text in the digest and sorts after all ids. Repeated rows are documents of their own,
with scores of their own texts and ranks one after another. Other columns don't enter. Empty tables give empty results;
an empty target has gains of its zero counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, pack, stored, unpack

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FAN = 16
SAMPLE = 1_000_000
RANGE_ROWS = 262_144
#: Sorts after every id.
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    """Percent of the eligible documents that are drawn, and what goes into a score."""

    longest: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least: int = 20
    percent: int = 10


def _run(words: Column, n: int, bucket):
    return lambda i: bucket(F.array_join(F.slice(words, i, n), " "))


def feature_buckets(text: Column, settings: Settings) -> Column:
    """array<bigint>: the bucket of every run of 1 to `longest` words, repeats kept."""
    found = F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAPS), "")
    bucket = lambda run: F.crc32(run.cast("binary")) % F.lit(settings.buckets)
    if settings.longest == 1:
        return F.transform(found, bucket)

    def runs(words: Column) -> Column:
        made = [F.transform(words, bucket)]
        for n in range(2, settings.longest + 1):
            at = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
            made.append(F.when(F.size(words) >= n, F.transform(at, _run(words, n, bucket))).otherwise(F.array().cast("array<bigint>")))
        return F.concat(*made)

    # The words are bound once for each text, however many runs look at them.
    return F.flatten(F.transform(F.array(found), runs))


def bucket_counts(texts: DataFrame, text: str, settings: Settings) -> np.ndarray:
    """How many features of all texts each bucket holds."""
    found = texts.select(F.explode(feature_buckets(F.col(f"`{text}`"), settings)).alias("bucket")).groupBy("bucket").count().collect()  # at most one row a bucket
    counts = np.zeros(settings.buckets, dtype=np.int64)
    for row in found:
        counts[row["bucket"]] = row["count"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 * log ratio) of each bucket, both sides smoothed by one feature a bucket."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return [math.floor(1000 * math.log((float(t) + 1) * (s_all + k) / ((float(s) + 1) * (t_all + k)))) for s, t in zip(source, target, strict=True)]


def _array(values: list[int]) -> Column:
    """A constant array; it is folded into one literal, so the plan stays small."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, target: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Stored (row, doc_id, n_features, n_words, weight, score) of every document."""
    table = _array(gains(bucket_counts(docs, text, settings), bucket_counts(target, target_text, settings)))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), feature_buckets(F.col(f"`{text}`"), settings).alias("_b"))
    n = F.size("_b").cast("long")
    # With runs of up to L words, n words have L*n - L*(L-1)/2 features where n >= L - 1, which is undone here.
    shorter = settings.longest * (settings.longest - 1) // 2
    n_words = F.when(n > 0, F.floor((n + shorter) / settings.longest)).otherwise(F.lit(0)) if settings.longest > 1 else n
    weight = F.aggregate("_b", F.lit(0).cast("bigint"), lambda acc, b: acc + F.get(table, b.cast("int")))
    found = rows.select("doc_id", n.alias("n_features"), n_words.alias("n_words"), weight.alias("weight"), noise(F.col("doc_id"), settings.seed).alias("_noise"))
    found = found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_features", "n_words", "weight", (F.col("weight") + F.col("_noise")).alias("score"))
    return stored(found, "resampling-weights")


# -- sorted runs and their merge ----------------------------------------------------------------------------------
class Tournament:
    """Merges sorted iterators of key tuples, smallest first: a tree of losers, one match a level for every key."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self._runs = runs
        self._heads = [next(run, None) for run in runs]
        k = len(runs)
        self._losers = [0] * k
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self._losers[node] = (a, b) if self._before(a, b) else (b, a)
        self._champion = winners[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        left, right = self._heads[a], self._heads[b]
        return left is not None and (right is None or left <= right)

    def __iter__(self) -> Iterator[tuple]:
        return self

    def __next__(self) -> tuple:
        at = self._champion
        head = self._heads[at] if self._heads else None
        if head is None:
            raise StopIteration
        self._heads[at] = next(self._runs[at], None)
        node = (at + len(self._runs)) // 2
        while node:
            if self._before(self._losers[node], at):
                at, self._losers[node] = self._losers[node], at
            node //= 2
        self._champion = at
        return head


def merged(runs: list[Iterator[tuple]], fan: int = FAN) -> Iterator[tuple]:
    """All keys of sorted runs in order, by a tree of tournaments with `fan` runs each."""
    while len(runs) > fan:
        runs = [Tournament(runs[i : i + fan]) for i in range(0, len(runs), fan)]
    return Tournament(runs)


#: A key is (-score, doc_id, row): in this order, ties to the smaller id.
KEY = ("rank_key", "id_key", "row")


def _keyed(weighted: DataFrame, least: int) -> DataFrame:
    return weighted.where(F.col("n_words") >= least).select((-F.col("score")).alias("rank_key"), F.coalesce("doc_id", F.lit(NO_ID)).alias("id_key"), "row")


def _cuts(keyed: DataFrame, count: int, ranges: int) -> list[tuple[int, int, int]]:
    """Keys that cut the order into about `ranges` even parts, from a bounded sample."""
    wanted = min(SAMPLE // 2, 128 * ranges)
    drawn = keyed.sample(min(1.0, wanted / count), seed=1).limit(SAMPLE).toPandas()
    keys = sorted(drawn.itertuples(index=False, name=None))
    step = len(keys) / ranges
    return sorted({tuple(map(int, keys[int(i * step)])) for i in range(1, ranges)}) if len(keys) >= ranges else sorted({tuple(map(int, k)) for k in keys})


def _range_of(pdf: pd.DataFrame, cuts: list[tuple[int, int, int]]) -> np.ndarray:
    """How many cuts are not after each key."""
    at = np.zeros(len(pdf), dtype=np.int64)
    if not cuts:
        return at
    first = np.array([c[0] for c in cuts])
    low, high = np.searchsorted(first, pdf["rank_key"], side="left"), np.searchsorted(first, pdf["rank_key"], side="right")
    at[:] = low
    for i in np.flatnonzero(low < high):
        key = (pdf["rank_key"].iat[i], pdf["id_key"].iat[i], pdf["row"].iat[i])
        lo, hi = int(low[i]), int(high[i])
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if cuts[mid] <= key else (lo, mid)
        at[i] = lo
    return at


def draw(weighted: DataFrame, settings: Settings = Settings(), range_rows: int = RANGE_ROWS) -> DataFrame:
    """(row, rank) of the drawn documents: the exact top of the order."""
    spark = weighted.sparkSession
    keyed = _keyed(weighted, settings.least)
    count = keyed.count()
    wanted = settings.percent * count // 100
    schema = "row long, rank long"
    if not wanted:
        return spark.createDataFrame([], schema)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // range_rows))
    cuts = spark.sparkContext.broadcast(_cuts(keyed, count, ranges))  # one key a range, at most SAMPLE

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(cuts.value) + 1, dtype=np.int64)
        for pdf in batches:
            total += np.bincount(_range_of(pdf, cuts.value), minlength=len(total))
        held = np.flatnonzero(total)
        yield pd.DataFrame({"range": held, "n": total[held]})

    held = keyed.mapInPandas(tally, "range long, n long").groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").toPandas()  # one row a range
    before = dict(zip(held["range"], held["n"].cumsum() - held["n"], strict=True))
    last = max(r for r, n in before.items() if n < wanted)
    starts = spark.sparkContext.broadcast(before)

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Packed slices of a sorted run; a slice ends with its range or its batch."""
        run, seq = TaskContext.get().partitionId(), 0
        for pdf in batches:
            at = _range_of(pdf, cuts.value)
            values = np.column_stack([pdf[f] for f in KEY]).astype(np.int64)
            edges = np.flatnonzero(np.diff(at)) + 1
            out = []
            for part in np.split(np.arange(len(at)), edges):
                if len(part) and at[part[0]] <= last:
                    out.append((int(at[part[0]]), run, seq, len(part), pack(values[part].T.ravel())))
                    seq += 1
            yield pd.DataFrame(out, columns=["range", "run", "seq", "n", "slice"])

    # Only keys up to the last cut that is needed are sorted; the test of the whole key follows in `slices`.
    bound = cuts.value[last][0] if last < len(cuts.value) else None
    needed = keyed if bound is None else keyed.where(F.col("rank_key") <= bound)
    packed = needed.sortWithinPartitions(*KEY).mapInPandas(slices, "range long, run int, seq int, n int, slice binary")

    def opened(parts: pd.DataFrame) -> Iterator[tuple]:
        for raw, n in zip(parts["slice"], parts["n"], strict=True):
            yield from map(tuple, unpack(raw).reshape(len(KEY), n).T.tolist())

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        start = int(starts.value[group["range"].iloc[0]])
        runs = [opened(parts) for _, parts in group.sort_values(["run", "seq"]).groupby("run")]
        drawn = [row for _, _, row in islice(merged(runs), wanted - start)]
        return pd.DataFrame({"row": drawn, "rank": np.arange(start + 1, start + 1 + len(drawn))})

    return packed.groupBy("range").applyInPandas(merge, schema)


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for those not drawn."""
    weighted = weigh(docs, target, settings, doc_id, text, target_text)
    ranked = weighted.join(draw(weighted, settings), "row", "left")  # rows meet by their number, so repeated ids keep to themselves
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")
