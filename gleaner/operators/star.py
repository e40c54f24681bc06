"""Star schema pieces: stable keys, unknown members, conformed dimensions, bridges and demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


UNKNOWN_KEY = 0


def stable_key(*natural: Column | str) -> Column:
    """A surrogate key from the natural key alone; the same in every run, never the unknown member's."""
    key = F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in natural])
    return F.when(key == UNKNOWN_KEY, 1).otherwise(key)


def dimension(rows: DataFrame, natural: list[str], key: str, display: list[str] | None = None) -> DataFrame:
    """A member for each natural key, with the smallest of its display values, and the unknown member."""
    shown = display or []
    members = rows.dropna(subset=natural).groupBy(*natural).agg(*[F.min(c).alias(c) for c in shown]) if shown else rows.dropna(subset=natural).select(*natural).distinct()
    keyed = members.select(stable_key(*natural).alias(key), *natural, *shown)
    unknown = keyed.sparkSession.range(1).select(F.lit(UNKNOWN_KEY).cast("long").alias(key), *[F.lit("Unknown").cast(keyed.schema[c].dataType).alias(c) for c in [*natural, *shown]])
    return keyed.unionByName(unknown)


def with_key(facts: DataFrame, dim: DataFrame, on: list[str], key: str) -> DataFrame:
    """facts with the dimension's key; the unknown member's where the natural key is missing."""
    return facts.join(dim.select(*on, key), on, "left").withColumn(key, F.coalesce(key, F.lit(UNKNOWN_KEY).cast("long")))


def combinations(facts: DataFrame, left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Every left value with every right value of a fact; a fact without values keeps one row with nulls."""
    return facts.join(left, on, "left").join(right, on, "left")


def share(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; null for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2).cast("double")


def demand(bridge: DataFrame, jobs: DataFrame, job: str, value: str) -> DataFrame:
    """Jobs that mention a value, all jobs, and the share."""
    total = jobs.agg(F.countDistinct(job).alias("total_jobs"))
    found = bridge.groupBy(value).agg(F.countDistinct(job).alias("job_count"))
    return found.crossJoin(F.broadcast(total)).withColumn("job_percent", share(F.col("job_count"), F.col("total_jobs")))


def two_level_demand(mentions: DataFrame, roles: DataFrame, job: str, role: str, skill: str) -> DataFrame:
    """For each role and skill: jobs of the role, those that mention the skill, and their share."""
    totals = roles.groupBy(role).agg(F.countDistinct(job).alias("role_jobs"))
    pairs = roles.select(job, role).distinct().join(mentions.select(job, skill).distinct(), job)
    found = pairs.groupBy(role, skill).agg(F.count(F.lit(1)).alias("skill_jobs"))
    return found.join(totals, role).withColumn("skill_percent", share(F.col("skill_jobs"), F.col("role_jobs")))
