"""Bucketed tables and keyed state: several batches, late rows, restarts, bounded writes and bounded state."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from gleaner.streaming import buckets, jobs, keyed
from pyspark.sql import functions as F

SCHEMA = "job string, at int, run string"


def arrive(spark, folder, number, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{folder}/part={number}")
    return spark.readStream.schema(schema + ", part int").option("maxFilesPerTrigger", 1).parquet(f"file://{folder}").drop("part")


def written(base, number):
    found = [os.path.join(d, f) for d, _, names in os.walk(f"{base}/version={number}") for f in names if f.endswith(".parquet")]
    return len(found), sum(map(os.path.getsize, found))


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    base, merge = tmp_path / "table", jobs.merge_latest("job", "at", "run")
    table = buckets.BucketTable(spark, f"file://{base}", SCHEMA, ["job"], 32)
    arrive(spark, tmp_path / "in", 1, [(f"j{i}", 1, "x" * 200 + str(i)) for i in range(4000)])
    stream = arrive(spark, tmp_path / "in", 2, [("j7", 2, "newer"), ("j7", 0, "late"), ("new", 1, "r")])
    found = {r["job"]: (r["at"], r["run"]) for r in buckets.keep_buckets(stream, table, merge).collect()}
    assert len(found) == 4001 and found["j7"] == (2, "newer") and found["new"] == (1, "r")
    (files, size), (few, little) = written(base, 0), written(base, 1)
    assert files == 32 and few <= 2 and little < size / 8  # bytes written go with the batch
    stream = arrive(spark, tmp_path / "in", 3, [("j7", 2, "newer"), ("j9", 1, "zz")])
    again = buckets.BucketTable(spark, f"file://{base}", SCHEMA, ["job"], 32)  # a restart goes on from the checkpoint
    found = {r["job"]: (r["at"], r["run"]) for r in buckets.keep_buckets(stream, again, merge).collect()}
    assert len(found) == 4001 and found["j9"] == (1, "zz") and buckets.last_batch(again) == 2
    assert buckets.keep_buckets(stream, again, merge).count() == 4001  # nothing has arrived
    batch = spark.createDataFrame([("j7", 2, "newer"), ("j9", 1, "zz")], SCHEMA)
    again.put(batch, 2, merge)  # a batch that comes twice replaces itself
    assert {tuple(r) for r in again.read(2).where("job IN ('j7', 'j9')").collect()} == {("j7", 2, "newer"), ("j9", 1, "zz")} and again.read(2).count() == 4001
    assert again.read(0).count() == 4000  # older states stay readable until they are removed
    gone = again.vacuum([2])
    assert gone and all(name.startswith(("version=0", "version=1")) for name in gone) and again.read(2).count() == 4001 and again.vacuum([2]) == []
    other = again.rebucketed(2, f"file://{tmp_path}/other", 5)
    assert sorted(map(tuple, other.read(2).collect())) == sorted(map(tuple, again.read(2).collect())) and len(other.versions(2)) <= 5


def test_bucket_table_with_nulls_and_empty_batches(spark, tmp_path):
    table = buckets.BucketTable(spark, f"file://{tmp_path}/t", SCHEMA, ["job"], 4)
    merge = jobs.merge_history("job", "run")
    table.put(spark.createDataFrame([], SCHEMA), 0, merge)
    assert table.read(0).count() == 0 and buckets.last_batch(table) == 0
    table.put(spark.createDataFrame([(None, None, "r"), ("a", 1, "r")], SCHEMA), 1, merge)
    assert {r["job"] for r in table.read(1).collect()} == {None, "a"}


def sights(spark, folder, base, **options):
    """Updates of everything that has arrived, with a checkpoint that stays."""
    keyed.use_rocksdb(spark)
    found = []
    stream = keyed.sights(folder, **options)
    job = stream.writeStream.outputMode("update").option("checkpointLocation", f"file://{base}").trigger(availableNow=True).foreachBatch(lambda df, n: found.extend(df.collect())).start()
    job.awaitTermination()
    return found


def test_keyed_state_over_batches_and_a_restart(spark, tmp_path):
    schema = "key string, at timestamp, value string"
    at = lambda day, hour=0: dt.datetime(2026, 1, day, hour)
    stream = arrive(spark, tmp_path / "in", 1, [("a", at(3), "v3"), ("a", at(2), "v2"), ("b", at(5), None), ("c", None, "no time")], schema)
    first = {r["key"]: r for r in sights(spark, stream, tmp_path / "state")}
    assert set(first) == {"a", "b"} and (first["a"]["first_seen"], first["a"]["last_seen"], first["a"]["newest"], first["a"]["n"]) == (at(2), at(3), "v3", 2)
    stream = arrive(spark, tmp_path / "in", 2, [("a", at(1), "late"), ("a", at(3), "v4")], schema)
    second = sights(spark, stream, tmp_path / "state")  # a restart: the state is read from the checkpoint, b doesn't come out again
    assert [(r["key"], r["first_seen"], r["last_seen"], r["newest"], r["n"]) for r in second] == [("a", at(1), at(3), "v4", 4)]


def test_keyed_state_forgets_keys_after_their_time(spark, tmp_path):
    schema = "key string, at timestamp, value string"
    at = lambda day: dt.datetime(2026, 1, day)
    for number, rows in enumerate([[("a", at(1), "x")], [("b", at(20), "y")], [("b", at(21), "z")]]):
        stream = arrive(spark, tmp_path / "in", number, rows, schema)
    found = sights(spark, stream, tmp_path / "state", late="1 day", ttl_ms=3 * 86_400_000)
    assert [(r["key"], r["n"]) for r in found if r["closed"]] == [("a", 1)]
    with pytest.raises(ValueError):
        keyed.sights(stream, ttl_ms=1)
