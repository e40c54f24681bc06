"""Approximate nearest neighbours with an inverted multi-index (largest inner product).

Vectors are cut into two halves, each quantised by its own small codebook (k-means over a bounded sample). A pair of
centroids is a cell; every vector is indexed in its cell. A query walks the cells by the sum of its two centroid
products, best first, with a heap over the two sorted lists, until the cells passed hold `fraction` of all vectors
(`least` at least). The cells of one first centroid form a group, cut into blocks of bounded size; queries are cut into
blocks too, and a block meets those queries of a query block that visit its group in one task, and candidates are reranked by the exact product of the original vectors
in double precision. A block gives at most top + 1 rows for a query.

Scores are summed component after component, in one order for every pair, so equal vectors tie on every query wherever they stand
and runs agree whatever the blocks. So of a group of equal vectors only the top + 1 smallest ids can be in a result: the
index keeps those, which is exact, and equal query vectors are searched once.

Every row is a candidate of its own, whatever its id: a row that is repeated finds its copy, and rows that share an id are told apart
by a row number that `usable` stores with them.

Defined results: vectors that are null, empty, zero, hold a null or non-finite component, or differ in length from the
most common length take no part; rows without an id neither. Each query row has a list; rows with one id have one each.
Fewer candidates than `top` give fewer rows. Ties go to the smaller id. Other columns don't enter. An empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored


@dataclass(frozen=True)
class Settings:
    top: int = 20
    centroids: int = 16
    sample: int = 4096
    fraction: float = 0.7
    least: int = 400
    block_rows: int = 65536
    query_rows: int = 16384
    rounds: int = 12


@dataclass
class Books:
    first: np.ndarray
    second: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        near = lambda part, book: np.argmin((book**2).sum(axis=1)[None, :] - 2 * part @ book.T, axis=1)
        return near(x[:, :half], self.first) * len(self.second) + near(x[:, half:], self.second)


def _k_means(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        owner = np.argmin((centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T, axis=1)
        for c in range(len(centres)):
            if (owner == c).any():
                centres[c] = x[owner == c].mean(axis=0)
    return centres


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Stored (row, vec_id, x) of the vectors that take part; row tells rows apart."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<float>").alias("x")).where(F.col("vec_id").isNotNull() & (F.size("x") > 0))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = rows.where(F.forall("x", finite) & F.exists("x", lambda v: v != 0))
    common = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return stored(rows.where(F.size("x") == (common["n"] if common else -1)).select(F.monotonically_increasing_id().alias("row"), "vec_id", "x"), "imi-usable")


def _matrix(x) -> np.ndarray:
    return np.array(x.tolist(), dtype=np.float64)


def _walk(books: Books, held: np.ndarray, q: np.ndarray, wanted: float) -> list[int]:
    """Cells in order of the sum of the two centroid products, until they hold `wanted` vectors."""
    half = books.first.shape[1]
    a, b = books.first @ q[:half], books.second @ q[half:]
    i_of, j_of = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    heap, pushed, cells, found = [(-(a[i_of[0]] + b[j_of[0]]), 0, 0)], {(0, 0)}, [], 0
    while heap and found < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(i_of[i]) * len(b) + int(j_of[j])
        if held[cell]:
            cells.append(cell)
            found += held[cell]
        for nxt in ((i + 1, j), (i, j + 1)):
            if nxt[0] < len(a) and nxt[1] < len(b) and nxt not in pushed:
                pushed.add(nxt)
                heapq.heappush(heap, (-(a[i_of[nxt[0]]] + b[j_of[nxt[1]]]), *nxt))
    return cells


def _best(scores: np.ndarray, q: np.ndarray, x: np.ndarray, slack: float, ids: np.ndarray, rows: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact scores of the best, ties to smaller ids, then rows. A matrix product gives equal vectors other last bits in
    other places, so all that come within `slack` of the last place are summed again, component after component."""
    floor = np.partition(scores, len(scores) - top)[len(scores) - top] - slack if len(scores) > top else -np.inf
    at = np.flatnonzero((scores >= floor) & np.isfinite(scores))
    exact = np.cumsum(x[at] * q, axis=1)[:, -1]
    order = np.lexsort((rows[at], ids[at], -exact))[:top]
    return at[order], exact[order]


def search(vectors: DataFrame, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's nearest; both inputs are (row, vec_id, x) frames from one call of `usable`."""
    s, spark = settings, vectors.sparkSession
    keep = s.top + 1
    index = vectors.withColumn("_n", F.row_number().over(W.partitionBy("x").orderBy("vec_id", "row"))).where(F.col("_n") <= keep).drop("_n")
    index = stored(index, "imi-vectors")
    asked = queries.groupBy("x").agg(F.min("row").alias("key"))
    drawn = index.orderBy(F.xxhash64("vec_id")).limit(s.sample).select("x").toPandas()
    if not len(drawn):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = _matrix(drawn["x"])
    half = max(1, sample.shape[1] // 2)
    first, second = (_k_means(part, s.centroids, s.rounds) if part.shape[1] else np.zeros((1, 0)) for part in (sample[:, :half], sample[:, half:]))
    books = spark.sparkContext.broadcast(Books(first, second))  # bounded by the settings

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=books.value.cells(_matrix(pdf["x"])).astype("int32"))

    cells = stored(index.mapInPandas(to_cells, "row long, vec_id long, x array<float>, cell int"), "imi-cells")
    counts = cells.groupBy("cell").count().toPandas()  # a row for each cell
    held = np.zeros(len(first) * len(second), dtype=np.int64)
    held[counts["cell"]] = counts["count"]
    width = len(second)
    blocks = np.maximum(1, -(-held.reshape(-1, width).sum(axis=1) // s.block_rows))
    wanted = max(s.least, s.fraction * held.sum())
    plan = spark.sparkContext.broadcast((held, blocks))
    asked_blocks = max(1, -(-asked.count() // s.query_rows))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held, blocks = plan.value
            out = {"part": [], "block": [], "key": [], "cells": [], "q": []}
            for key, x, q in zip(pdf["key"], pdf["x"], _matrix(pdf["x"]), strict=True):
                by_part: dict[int, list[int]] = {}
                for cell in _walk(books.value, held, q, wanted):
                    by_part.setdefault(cell // width, []).append(cell % width)
                for part, cells in by_part.items():
                    for block in range(blocks[part]):
                        for name, value in zip(out, (part, block, key, cells, x), strict=True):
                            out[name].append(value)
            yield pd.DataFrame(out)

    asking = asked.mapInPandas(visits, "part int, block int, key long, cells array<int>, q array<float>").withColumn("asked", F.pmod(F.xxhash64("key"), F.lit(asked_blocks)).cast("int"))
    part = F.floor(F.col("cell") / width).cast("int")
    block_of = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), part + 1)
    placed = cells.select(part.alias("part"), F.pmod(F.xxhash64("row"), block_of).cast("int").alias("block"), "row", "vec_id", "x", (F.col("cell") % width).alias("at"))
    placed = placed.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))

    def rerank(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(queries) and len(block):
            rows, ids, x, at = block["row"].to_numpy(), block["vec_id"].to_numpy(), _matrix(block["x"]), block["at"].to_numpy()
            step = max(1, 4_000_000 // len(block))
            longest = np.sqrt((x**2).sum(axis=1).max())
            for begin in range(0, len(queries), step):
                some = queries.iloc[begin : begin + step]
                asked_for = _matrix(some["q"])
                for key, visited, q, row in zip(some["key"], some["cells"], asked_for, asked_for @ x.T, strict=True):
                    open_ = np.zeros(width, dtype=bool)
                    open_[np.asarray(visited)] = True
                    row = np.where(open_[at], row, -np.inf)
                    slack = 4 * len(q) * np.finfo(float).eps * longest * np.sqrt((q**2).sum())
                    best, exact = _best(row, q, x, slack, ids, rows, keep)
                    out.append(pd.DataFrame({"key": key, "row": rows[best], "vec_id": ids[best], "score": exact}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "row": [], "vec_id": [], "score": []})

    found = asking.groupBy("part", "block", "asked").cogroup(placed.groupBy("part", "block", "asked")).applyInPandas(rerank, "key long, row long, vec_id long, score double")
    order = [F.desc("score"), F.asc("vec_id"), F.asc("row")]
    best = found.withColumn("_n", F.row_number().over(W.partitionBy("key").orderBy(*order))).where(F.col("_n") <= keep).drop("_n")
    members = queries.join(asked, "x").select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), "key")
    pairs = members.join(best, "key").where(F.col("query_row") != F.col("row"))
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy("query_row").orderBy(*order))).where(F.col("rank") <= s.top)
    return ranked.select("query_id", "rank", "vec_id", "score")
