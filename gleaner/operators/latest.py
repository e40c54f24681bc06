"""Top-1 by group, ranks within groups and grain checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark limits groups before the shuffle (WindowGroupLimit)."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def latest_by(df: DataFrame, keys: list[str], *newest: str) -> DataFrame:
    """The newest row of each key; later columns break ties."""
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def context_numbers(df: DataFrame, keys: list[str], level: str, out: str = "context_no") -> DataFrame:
    """Numbers from 0 within each key, null levels first."""
    w = W.partitionBy(*keys).orderBy(F.col(level).asc_nulls_first())
    return df.withColumn(out, (F.row_number().over(w) - 1).cast("int"))


def repeated_grains(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
