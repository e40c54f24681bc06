"""Streaming queries, held against their batch twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..storage import shared_dir
from ..streaming import buckets, jobs, keyed
from .base import query


@query("SELECT DISTINCT user_id FROM events")
def stream_first_claim(spark, d):
    return jobs.run_available(jobs.first_claims(jobs.read_stream(spark, d, "events.parquet"), "user_id"), "append")


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark, d):
    """The newest count of each day, from updates."""
    counts = jobs.daily_counts(jobs.read_stream(spark, d, "events.parquet"), "ts", "1 day", "event_type")
    return jobs.run_available(counts, "update").groupBy("day", "event_type").agg(F.max("n").alias("n"))


def _events(spark, d):
    return jobs.read_stream(spark, d, "events.parquet").select("user_id", "event_id", "ts", "event_type")


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_latest(spark, d):
    rows = _events(spark, d).drop("event_type")
    return jobs.keep_table(rows, rows.schema.simpleString()[7:-1].replace(":", " "), jobs.merge_latest("user_id", "ts", "event_id"))


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY 1")
def stream_first_last_seen(spark, d):
    return jobs.keep_table(_events(spark, d), "user_id long, first_seen timestamp_ntz, last_seen timestamp_ntz, n long", jobs.merge_seen("user_id", "ts"))


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE user_id % 3 = 0)")
def stream_incremental_scan(spark, d):
    """Rows of users that a registry doesn't know."""
    known = spark.read.parquet(f"{d}/events.parquet").where("user_id % 3 = 0").select("user_id").distinct()
    rows = _events(spark, d).select("event_id", "user_id")
    return jobs.keep_table(rows, "event_id long, user_id long", lambda stored, batch: jobs.merge_history("event_id")(stored, batch.join(known, "user_id", "left_anti")))


@query("SELECT event_id, user_id, ts FROM events")
def stream_history(spark, d):
    """Everything that was seen, by its grain."""
    rows = _events(spark, d).select("event_id", "user_id", "ts")
    return jobs.keep_table(rows, "event_id long, user_id long, ts timestamp_ntz", jobs.merge_history("event_id"))


@query("""SELECT CAST(user_id AS VARCHAR) AS key, min(ts) AS first_seen, max(ts) AS last_seen, CAST(arg_max(event_id, (ts, CAST(event_id AS VARCHAR))) AS VARCHAR) AS newest, count(*) AS n FROM events GROUP BY 1""")
def stream_keyed_sights(spark, d):
    """First and last sight and the newest event of each user, from keyed state."""
    keyed.use_rocksdb(spark)
    rows = jobs.read_stream(spark, d, "events.parquet").select(F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").cast("string").alias("value"))
    found = jobs.run_available(keyed.sights(rows), "update")
    newest = found.groupBy("key").agg(F.max_by(F.struct("first_seen", "last_seen", "newest", "n"), "n").alias("x"))
    return newest.select("key", F.col("x.first_seen").cast("timestamp_ntz").alias("first_seen"), F.col("x.last_seen").cast("timestamp_ntz").alias("last_seen"), "x.newest", "x.n")


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_latest_in_buckets(spark, d):
    """The newest event of each user, in a table of hash buckets."""
    rows = _events(spark, d).drop("event_type")
    table = buckets.BucketTable(spark, f"{shared_dir(spark)}/buckets-{uuid.uuid4().hex}", "user_id long, event_id long, ts timestamp_ntz", ["user_id"], 16)
    return buckets.keep_buckets(rows, table, jobs.merge_latest("user_id", "ts", "event_id"))
