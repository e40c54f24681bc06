"""Embedding whitening by TSQR: principal axes of all vectors from a tree of R factors, without a covariance matrix.

Entries are put on a grid of integers (x = floor(scale * c) + shift), so sums over vectors are exact. The fit list holds each
distinct x vector once. Every partition of it centres its rows with the exact sums and keeps the R factor of its QR
decomposition, block by block; a tree of `FAN` factors a task stacks and decomposes them again until one is left. The
right singular vectors of that R are the axes, its singular values their spread. Only sums (one number a dimension) and
the last R (dimensions squared) reach the driver; a hot vector is one row of the fit list, and copies meet before the shuffle.

Defined results: vectors that are null, empty, hold a null or non-finite entry or one whose x is no long, or differ in length
from the most common length of the fit list (of equally common ones the smallest), take no part. Components whose
spread is zero to double precision can't be whitened and give no rows; so a single distinct vector gives none. Rows are
judged one by one: repeated rows and null ids keep their rows. `deviation` is null where its exact value is no long;
`deviation_exact` has it always. Other columns don't enter. An empty table gives an empty result. Of the two signs of a
component that is taken which makes its largest entry positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FAN = 16
OUTPUT = "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Grid:
    scale: int = 64
    shift: int = 1_000_000


@dataclass
class Model:
    """Axes of the fit list: n vectors with per-dimension `sums`, unit `axes` as rows, their `spread` and share of the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    spread: np.ndarray
    explained: np.ndarray

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.axes.T / np.sqrt(self.spread)


def on_grid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", grid: Grid = Grid()) -> DataFrame:
    """(vec_id, x) of the vectors that take part, whatever their length."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("c")).where(F.size("c") > 0)
    fits = rows.where(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * grid.scale) < F.lit(2.0**62))))
    return fits.select("vec_id", F.transform("c", lambda c: F.floor(c * grid.scale) + F.lit(grid.shift)).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min())))


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: in longs where they suffice, else in Python integers."""
    if n * _largest(x) + max(abs(s) for s in sums) < 2**62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _squares(d: np.ndarray) -> list[int]:
    """Exact sums of squares by row."""
    exact = d if _largest(d) ** 2 * d.shape[1] < 2**63 else d.astype(object)
    return [int(v) for v in (exact * exact).sum(axis=1)]


def _centred(d: np.ndarray, n: int) -> np.ndarray:
    return (d / n).astype(np.float64)


def _sums(fit: DataFrame) -> list[int]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | int = 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                safe = _largest(x) * len(x) < 2**63
                total = total + (x if safe else x.astype(object)).sum(axis=0).astype(object)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))], ["at", "total"])

    found = fit.mapInArrow(add, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()  # a row a dimension
    return [int(r["total"]) for r in found]


def _r_factor(*parts: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def tsqr(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The R factor of all centred rows of fit."""
    dims = len(sums)
    load = lambda raw: np.frombuffer(raw).reshape(-1, dims)

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if batch.num_rows:
                rows = _centred(_scaled(_matrix(batch), n, sums), n)
                r = _r_factor(rows) if r is None else _r_factor(r, rows)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["slot", "r"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        r = _r_factor(*[load(raw) for raw in group.sort_values("slot")["r"]])
        return pd.DataFrame({"slot": [group["slot"].iloc[0] // FAN], "r": [r.tobytes()]})

    schema = "slot long, r binary"
    level = stored(fit.mapInArrow(of_partition, schema), "tsqr-factors")
    slots = level.agg(F.max("slot")).first()[0] + 1
    while slots > 1:
        level = level.groupBy(F.expr(f"slot div {FAN}").alias("_at")).applyInPandas(merge, schema)
        slots = -(-slots // FAN)
    return load(level.first()["r"])


def fit_model(fit: DataFrame, components: int = 16) -> Model | None:
    """The model of a stored frame of distinct x vectors of one length; None where there is nothing to whiten."""
    n = fit.count()
    if not n:
        return None
    sums = _sums(fit)
    _, s, axes = np.linalg.svd(tsqr(fit, n, sums))
    spread = s**2 / n
    keep = min(components, int((s > s[0] * 64 * len(sums) * np.finfo(float).eps).sum()))
    axes = axes[:keep]
    signs = np.sign(axes[np.arange(keep), np.argmax(np.abs(axes), axis=1)])
    return Model(n, sums, axes * signs[:, None], spread[:keep], spread[:keep] / spread.sum()) if keep else None


def identity_error(fit: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the whitened fit list, minus the identity."""
    shared, k = fit.sparkSession.sparkContext.broadcast(model), len(model.spread)  # dimensions x components

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, total = shared.value, np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = m.whiten(_centred(_scaled(_matrix(batch), m.n, m.sums), m.n))
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["at", "v"])

    found = fit.mapInArrow(moments, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()  # components squared
    total = np.array([r["v"] for r in found]).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 16, grid: Grid = Grid()) -> DataFrame:
    """A row for each vector that takes part and each component (OUTPUT)."""
    spark = vectors.sparkSession
    rows = on_grid(vectors, vec_id, embedding, grid)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    length = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    same = lambda df: df.where(F.size("x") == (length["d"] if length else -1))
    fit = same(fit)
    model = fit_model(fit, components)
    if model is None:
        return spark.createDataFrame([], OUTPUT)
    error = identity_error(fit, model)
    shared = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.spread)
        for batch in batches:
            if batch.num_rows:
                d = _scaled(_matrix(batch), m.n, m.sums)
                squares, w = _squares(d), m.whiten(_centred(d, m.n))
                row = pa.array(np.repeat(np.arange(len(w)), k))
                fits = pa.array([v if v < 2**63 else None for v in squares], pa.int64())
                exact = pa.array([Decimal(v) for v in squares], pa.decimal128(38, 0))
                each = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(w)), np.full(len(row), m.n)]
                last = [w.ravel(), np.tile(m.explained, len(w)), np.full(len(row), error)]
                columns = [batch.column("vec_id").take(row), *map(pa.array, each), fits.take(row), exact.take(row), *map(pa.array, last)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUTPUT.split(", ")])

    return same(rows).mapInArrow(project, OUTPUT)
