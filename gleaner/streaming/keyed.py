"""Keyed state in streams: the newest row and the span of sights of each key, held by the state store with a time to live.

Where a table in storage isn't needed, the state is the table: a batch costs what it holds, whatever the number of keys, and what
changed comes out as updates. Late and repeated rows change nothing that is newer. With `ttl` a key that isn't seen for so long
(in event time, by a timer that the watermark fires) is given out once more as closed and forgotten, so the state is bounded by the
keys of that time. The state lives in RocksDB and is checkpointed with the stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
UPDATES = "key string, first long, last long, newest string, n long, closed boolean"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that timers and time to live need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class Sights(StatefulProcessor):
    """For each key: first and last sight, the newest row's value (ties to the larger), how many rows; closed after `ttl_ms`."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("sights", "first long, last long, newest string, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first, last, newest, n = self.held.get() if self.held.exists() else (None, None, None, 0)
        before = last
        for pdf in rows:
            top = pdf.sort_values(["us", "value"]).iloc[-1]
            first = min(int(pdf["us"].min()), first if first is not None else int(top["us"]))
            if last is None or (int(top["us"]), top["value"]) > (last, newest):
                last, newest = int(top["us"]), str(top["value"])
            n += len(pdf)
        self.held.update((first, last, newest, n))
        if self.ttl_ms is not None and last != before:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(last // 1000 + self.ttl_ms)
        yield self._row(key, first, last, newest, n, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first, last, newest, n = self.held.get()
        self.held.clear()
        yield self._row(key, first, last, newest, n, True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, first: int, last: int, newest: str, n: int, closed: bool) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "first": [first], "last": [last], "newest": [newest], "n": [n], "closed": [closed]})


def sights(events: DataFrame, late: str | None = None, ttl_ms: int | None = None) -> DataFrame:
    """(key, first_seen, last_seen, newest, n, closed) of every key that a batch changes, from (key string, at timestamp, value string). Rows
    without a time are left out. `late` bounds how late rows may come; ttl_ms needs it."""
    if ttl_ms is not None and late is None:
        raise ValueError("a time to live needs a bound on late rows")
    events = events.where("at IS NOT NULL").select("key", "at", F.coalesce("value", F.lit("")).alias("value"), F.unix_micros("at").alias("us"))
    events = events.withWatermark("at", late) if late else events
    found = events.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Sights(ttl_ms), outputStructType=UPDATES, outputMode="Update", timeMode="EventTime" if ttl_ms is not None else "None"
    )
    return found.select("key", F.timestamp_micros("first").alias("first_seen"), F.timestamp_micros("last").alias("last_seen"), "newest", "n", "closed")
