"""Tables that are written to be read again: in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder if the master is local, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='gleaner-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df, written and read again: cuts the lineage, survives lost executors, and is worked out once."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task sorts or holds by key: few enough for their joins and groups to stay in its memory, whatever the size of the input.
ROWS_A_TASK = 500_000


def partitions(df: DataFrame, rows: int = ROWS_A_TASK) -> int:
    """How many partitions the rows of a table ask for; never fewer than the session's. Rows of Parquet are counted from its footers."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly over all cores: for rows that weigh little and cost much, since a small file (or row group) is one task."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
