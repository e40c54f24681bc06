"""Mixing sources to target weights with the cube method.

Every source gets a target (in words) from cyclic weights, with a ceiling of `ceiling` times its own size; the
excess of a capped source is shared again by weight among the rest. A document is then taken floor(r) times, plus
once more with probability frac(r), r = target / size of its source. Which documents get the extra copy is a
balanced sample: the flight phase moves the fractional inclusion probabilities along the null space of the two
balancing constraints (words taken, documents taken) until they are 0 or 1. It runs in bounded blocks of every
source; each block leaves at most two fractional documents, which meet in the blocks of the next round. What is left
when a source has one block, at most two documents, is the landing problem: one more flight step with the word
constraint alone, one draw, and exchanges of the documents that best make up for the draw's remainder. The exchanges
(EXCHANGES a source at most) trade exact inclusion probabilities of these few documents for words near the target.

Random numbers are hashes of the row's key, so reruns agree. Defined results: null and empty texts have size 0,
take part in their source's counts and are taken 0 words; a source without words has target 0; the null source comes
last in the order of sources. Rows with the same doc_id are separate documents. Columns that
clash with the operator's own names stay as they are in mixed_documents. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CEILING = 2.0
BLOCK_ROWS = 4096
SEED = 20240229
EXCHANGES = 16

STATE = "uid long, rank long, size long, h long, p double"


def _ranked(sources: DataFrame) -> DataFrame:
    """sources with `rank` from 0 in code-point order, null last; no task sees more than its range of them."""
    by_range = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    placed = stored(by_range.withColumn("_at", F.monotonically_increasing_id()), "mix-sources")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part").count().orderBy("_part").collect()  # a row for each partition
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["_part"], total))
        total += row["count"]
    if not offsets:
        return placed.select("source", "source_size", "n", F.lit(0).cast("long").alias("rank"))
    starts = F.create_map(*[F.lit(x) for pair in offsets for x in pair])
    return placed.select("source", "source_size", "n", (starts[F.col("_part")] + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long").alias("rank"))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """(source, source_size, n, rank, target) from (source, size) rows.

    Water filling: a source's target is min(ceiling * size, level * weight); the level is raised until the targets
    sum to share * all sizes. Each step is one small aggregate over the sources.
    """
    sources = _ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = stored(sources.withColumn("w", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))), "mix-ranked")
    most = ceiling * F.col("source_size")
    level = 0.0
    while True:
        open_ = most > level * F.col("w")
        row = sources.agg(
            F.sum(F.when(~open_, most)).alias("closed"), F.sum(F.when(open_, F.col("w"))).alias("weight"), F.sum("source_size").alias("all")
        ).first()
        if not row["weight"]:
            break
        raised = (share * row["all"] - (row["closed"] or 0.0)) / row["weight"]
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(most.cast("double"), level * F.col("w")))


def _flight(sizes: list[float], p: list[float], draws: list[float], by_count: bool) -> None:
    """Move p along the null space of the constraints until at most 2 (by_count) or 1 entries stay fractional."""
    need = 3 if by_count else 2
    active: list[int] = []
    eps = 1e-9
    for k in range(len(p)):
        if not eps < p[k] < 1 - eps:
            p[k] = float(round(p[k]))
            continue
        active.append(k)
        if len(active) < need:
            continue
        s = [sizes[i] for i in active]
        if by_count:
            u = [s[1] - s[2], s[2] - s[0], s[0] - s[1]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        else:
            u = [s[1], -s[0]]
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(active, u, strict=True) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(active, u, strict=True) if v)
        step = up if draws[k] * (up + down) < down else -down
        for i, v in zip(active, u, strict=True):
            p[i] += step * v
            if p[i] < eps or p[i] > 1 - eps:
                p[i] = float(round(p[i]))
        active = [i for i in active if eps < p[i] < 1 - eps]


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block's flight, largest documents first, so that small ones are left."""
    pdf = pdf.sort_values(["size", "h", "uid"], ascending=[False, True, True], ignore_index=True)
    sizes, p = pdf["size"].astype(float).tolist(), pdf["p"].tolist()
    draws = ((pdf["h"].to_numpy().astype("uint64") >> 11) / 2.0**53).tolist()
    _flight(sizes, p, draws, by_count=True)
    return pdf.assign(p=p)[["uid", "rank", "size", "h", "p"]]


def _landing(pdf: pd.DataFrame) -> pd.DataFrame:
    """The only block of its source: its flight, a step that keeps the words alone, a draw, and exchanges."""
    wanted = float((pdf["size"] * pdf["p"]).sum())
    pdf = _block(pdf)
    p = pdf["p"].tolist()
    draws = ((pdf["h"].to_numpy().astype("uint64") >> 11) / 2.0**53).tolist()
    _flight(pdf["size"].astype(float).tolist(), p, draws, by_count=False)
    x = np.array([x if x in (0.0, 1.0) else float(d < x) for x, d in zip(p, draws, strict=True)])
    sizes = pdf["size"].to_numpy(dtype=float)
    missing = wanted - float(sizes @ x)
    for _ in range(EXCHANGES):
        change = np.where(x == 0.0, sizes, -sizes)
        k = int(np.argmin(np.abs(missing - change)))
        if abs(missing - change[k]) >= abs(missing):
            break
        missing -= change[k]
        x[k] = 1.0 - x[k]
    return pdf.assign(p=x)


def cube_sample(units: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(uid, p) with p 0 or 1, from (uid, rank, size, h, p): a balanced sample within each rank.

    Each round deals the fractional units of a rank into blocks by their hash; a block of n units leaves two. Units that share a hash
    (rows repeated with id and size) stay together, so that any split of the input gives the same result, unless they are too many for
    a block: then their row numbers spread them.
    """
    fractional, done = units, []
    while True:
        alike = fractional.groupBy("rank", "h").agg(F.count(F.lit(1)).alias("k"))
        per = alike.groupBy("rank").agg(F.sum("k").alias("k"))
        blocks = per.select("rank", F.ceil(F.col("k") / block_rows).alias("blocks"))
        most = blocks.agg(F.max("blocks")).first()[0] or 0
        last = most <= 1
        many = alike.where(F.col("k") > block_rows // 4).select("rank", "h", F.lit(True).alias("many"))
        spread = F.when(F.col("many"), F.col("uid")).otherwise(F.lit(0))
        dealt = fractional.join(blocks, "rank").join(many, ["rank", "h"], "left").withColumn("block", F.pmod(F.xxhash64("h", F.lit(most), spread), F.col("blocks"))).repartition("rank", "block")
        moved = stored(dealt.groupBy("rank", "block").applyInPandas(_landing if last else _block, STATE), "mix-flight")
        settled = F.col("p").isin(0.0, 1.0)
        done.append(moved.where(settled).select("uid", "p"))
        if last:
            break
        fractional = moved.where(~settled)
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


def mix_sizes(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(uid, doc_id, source, size, source_size, target, copies) from stored (uid, doc_id, source, size) rows."""
    targets = source_targets(sized, weights, share, ceiling)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "uid", "doc_id", sized["source"], "size", "source_size", "target", "rank", ratio.alias("ratio")
    )
    planned = joined.withColumn("whole", F.floor(F.col("ratio") + 1e-9)).withColumn("p", F.greatest(F.lit(0.0), F.col("ratio") - F.col("whole")))
    h = F.xxhash64(F.lit(SEED), "doc_id", "size")
    units = planned.where((F.col("size") > 0) & (F.col("p") > 1e-9)).select("uid", "rank", "size", h.alias("h"), "p")
    extra = cube_sample(units, block_rows).where("p = 1").select("uid", F.lit(1).alias("extra"))
    return planned.join(extra, "uid", "left").select(
        "uid",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("copies"),
    )


def size_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Stored (uid, doc_id, source, size) of every row; size is the number of words."""
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("uid"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size")
        ),
        "mix-sizes",
    )


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document."""
    return mix_sizes(size_documents(docs)).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns it came with."""
    kept = stored(docs.select(F.monotonically_increasing_id().alias("_uid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")), "mix-docs")
    sized = stored(
        kept.select(F.col("_uid").alias("uid"), F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"), word_count(F.col("_row.text")).alias("size")), "mix-sizes"
    )
    copies = mix_sizes(sized).where("copies > 0").select(F.col("uid").alias("_uid"), "copies")
    return kept.join(copies, "_uid").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
