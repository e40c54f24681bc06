"""Incremental twins of batch operators, as Structured Streaming jobs that run to the end of what has arrived."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import latest
from ..storage import shared_dir


def _base(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Files of a table that lies in a folder, as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def run_available(stream: DataFrame, mode: str) -> DataFrame:
    """Process everything that has arrived, with a checkpoint in the shared folder; gives the sink's rows. Batches are
    written under their number, so a repeated batch replaces itself."""
    spark, base = stream.sparkSession, _base(stream.sparkSession)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    job = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(put).start()
    job.awaitTermination()
    if job.exception():
        raise job.exception()
    return spark.read.schema(stream.schema).parquet(f"{base}/out/batch=*")


def first_claims(events: DataFrame, key: str, within: tuple[str, str] | None = None) -> DataFrame:
    """Each key once over the whole stream: the state keeps every key for ever. With within = (time column, delay), each key once
    within the delay, and the state forgets keys that are older."""
    if within is None:
        return events.select(key).dropDuplicates([key])
    ts, delay = within
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key]).select(key)


def daily_counts(events: DataFrame, ts: str, late: str, *keys: str) -> DataFrame:
    """Counts by day. In append mode a day comes out once, final, when the watermark has passed it, and its state is dropped; in update
    mode it comes out again with every batch that changes it."""
    return (
        events.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late)
        .groupBy(F.window(ts, "1 day"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date(F.col("window.start")).alias("day"), *keys, "n")
    )


# -- tables that a stream keeps up to date -----------------------------------------------------------------------
class Snapshots:
    """A table as numbered snapshots under one folder: batch n's snapshot is made of the one before and the batch alone, so a batch that
    is run again replaces itself. Single writer."""

    def __init__(self, spark: SparkSession, base: str, schema: str) -> None:
        self.spark, self.base, self.schema = spark, base, schema

    def before(self, number: int) -> DataFrame:
        """The snapshot that batch `number` starts from."""
        return self.spark.createDataFrame([], self.schema) if number == 0 else self.spark.read.parquet(f"{self.base}/snapshot={number - 1}")

    def put(self, df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.base}/snapshot={number}")


def keep_table(stream: DataFrame, schema: str, merge: Callable[[DataFrame, DataFrame], DataFrame], files: int = 1) -> DataFrame:
    """Run a stream to the end of what has arrived; merge(stored, batch) gives the next snapshot. Gives the last one."""
    spark, base = stream.sparkSession, _base(stream.sparkSession)
    table, last = Snapshots(spark, base, schema), [-1]

    def put(batch: DataFrame, number: int) -> None:
        table.put(merge(table.before(number), batch), number)
        last[0] = number

    job = stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(put).start()
    job.awaitTermination()
    if job.exception():
        raise job.exception()
    return table.before(last[0] + 1)


def merge_latest(key: str, *newest: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Keeps the newest row of each key; a late row that is older changes nothing."""
    return lambda stored, batch: latest.latest_by(stored.unionByName(batch.select(*stored.columns)), [key], *newest)


def merge_history(*grain: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Appends rows whose grain is new, late ones too; a batch that comes again adds nothing."""

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        fresh = batch.select(*stored.columns).dropDuplicates(list(grain))
        return stored.unionByName(fresh.join(stored.select(*grain), list(grain), "left_anti"))

    return merge


def merge_seen(key: str, ts: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """(key, first_seen, last_seen, n): the span of sights, whatever the order in which they arrive."""

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        new = batch.groupBy(key).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("n"))
        both = stored.unionByName(new)
        return both.groupBy(key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("n").alias("n"))

    return merge


def unknown_only(known: DataFrame, key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Rows of keys that neither a registry nor an earlier batch holds: what an incremental scan has to fetch."""
    append = merge_history(key)
    return lambda stored, batch: append(stored, batch.join(known.select(key), key, "left_anti"))
