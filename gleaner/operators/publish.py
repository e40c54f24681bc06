"""Publishing: immutable snapshots and a manifest that names the current one, moved only after all gates have passed.

One writer at a time: a publisher that states which snapshot it started from is refused if another has become current, and two
entries of one number, which only racing writers can leave, are refused by every reader."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality


class PublishRejected(Exception):
    """A gate failed; the current snapshot stays."""


def write_snapshot(root: str, tables: dict[str, DataFrame]) -> str:
    """All tables under a new snapshot id."""
    snapshot = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.option("compression", "zstd").parquet(f"{root}/snapshot={snapshot}/{name}")
    return snapshot


def read_snapshot(spark: SparkSession, root: str, snapshot: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/snapshot={snapshot}/{name}")


def history(spark: SparkSession, root: str) -> list[dict]:
    """Manifest entries, oldest first; each move of the pointer is one small file."""
    try:
        rows = spark.read.text(f"{root}/manifest").collect()
    except Exception as error:  # no manifest has been written yet
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise
    entries = sorted((json.loads(r[0]) for r in rows), key=lambda e: e["number"])
    if [e["number"] for e in entries] != list(range(len(entries))):
        raise PublishRejected("the manifest has been written by two publishers at once")
    return entries


def current(spark: SparkSession, root: str) -> str | None:
    entries = history(spark, root)
    return entries[-1]["snapshot"] if entries else None


def _point_to(spark: SparkSession, root: str, snapshot: str, action: str) -> None:
    entry = {"number": len(history(spark, root)), "snapshot": snapshot, "action": action}
    spark.range(1).select(F.lit(json.dumps(entry)).alias("value")).coalesce(1).write.mode("append").text(f"{root}/manifest")


ANY = object()


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], gates, expected=ANY) -> str:
    """Write a snapshot, run gates(read) over what was written, and make it current if all pass and `expected`, where it is given, is
    still the current one."""
    snapshot = write_snapshot(root, tables)
    report = gates(lambda name: read_snapshot(spark, root, snapshot, name))
    if not quality.all_pass(report):
        failed = [r["check_name"] for r in report.where("status <> 'pass'").collect()]
        raise PublishRejected(f"snapshot {snapshot}: {', '.join(failed)}")
    if expected is not ANY and current(spark, root) != expected:
        raise PublishRejected(f"snapshot {snapshot}: another snapshot has become current")
    _point_to(spark, root, snapshot, "publish")
    return snapshot


def rollback(spark: SparkSession, root: str, expected: str) -> str:
    """Back to the snapshot before the current one, which must be `expected`."""
    entries = history(spark, root)
    if not entries or entries[-1]["snapshot"] != expected:
        raise PublishRejected("the current snapshot is not the expected one")
    earlier = [e["snapshot"] for e in entries if e["snapshot"] != expected]
    if not earlier:
        raise PublishRejected("there is no earlier snapshot")
    _point_to(spark, root, earlier[-1], "rollback")
    return earlier[-1]
