"""Session factory with the settings every query of this library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benches; on a cluster, pass the session you have to the queries instead."""
    builder = SparkSession.builder.master(master).config(map=SETTINGS)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.driver.memory", "8g")
    for key, value in extra.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
