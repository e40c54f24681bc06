"""Reconciliation gates: every check is one row of a report; publishing asks that all of them pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import repeated_grains

REPORT = ("check_name", "expected", "actual", "status")


def _line(counts: DataFrame, name: str, expected: Column, actual: Column) -> DataFrame:
    status = F.when(expected.eqNullSafe(actual), "pass").otherwise("fail")
    return counts.select(F.lit(name).alias("check_name"), expected.cast("long").alias("expected"), actual.cast("long").alias("actual"), status.alias("status"))


def same_count(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.agg(F.count(F.lit(1)).alias("x")).crossJoin(b.agg(F.count(F.lit(1)).alias("y")))
    return _line(both, name, F.col("x"), F.col("y"))


def same_sum(name: str, a: DataFrame, b: DataFrame, measure: str) -> DataFrame:
    both = a.agg(F.coalesce(F.sum(measure), F.lit(0)).alias("x")).crossJoin(b.agg(F.coalesce(F.sum(measure), F.lit(0)).alias("y")))
    return _line(both, name, F.col("x"), F.col("y"))


def none_of(name: str, violations: DataFrame) -> DataFrame:
    return _line(violations.agg(F.count(F.lit(1)).alias("x")), name, F.lit(0), F.col("x"))


def unique_grain(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return none_of(name, repeated_grains(df, keys))


def no_orphans(name: str, child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    return none_of(name, child.join(parent.select(*keys).distinct(), keys, "left_anti"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, with the side; null equals null, repetition does not count."""
    b = b.select(*a.columns)
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def same_rows(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    return none_of(name, differences(a, b))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def all_pass(found: DataFrame) -> bool:
    return found.where("status <> 'pass'").limit(1).count() == 0


def row_digest(columns: list[str]) -> Column:
    """Digest of a row: each value with its length before it, null apart from the empty text."""
    value = lambda c: F.col(c).cast("string")
    marked = [F.coalesce(F.concat(F.octet_length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*marked), 256)


def content_fingerprint(rows: DataFrame, keys: list[str], digits: int = 2) -> DataFrame:
    """One digest for each key over the sorted digests of its rows, in two levels: rows whose digests begin alike are digested
    first, so that no group holds all rows of a hot key. More digits make the groups smaller."""
    hashed = rows.select(*keys, row_digest(rows.columns).alias("_h"))
    parts = hashed.groupBy(*keys, F.substring("_h", 1, digits).alias("_p")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("_h")), ""), 256).alias("_d"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_p", "_d"))), lambda x: F.concat(x["_p"], x["_d"])), "")
    return parts.groupBy(*keys).agg(F.sha2(whole, 256).alias("fingerprint"))


def mapping_complete(name: str, rows: DataFrame, mapped: DataFrame, keys: list[str]) -> DataFrame:
    """Every row finds its member."""
    return no_orphans(name, rows, mapped, keys)


def no_collapse(name: str, source: DataFrame, mapped: DataFrame, keys: list[str]) -> DataFrame:
    """Mapping to new keys keeps the number of distinct grains."""
    return same_count(name, source.distinct(), mapped.select(*keys).distinct())


def at_least(name: str, larger: DataFrame, smaller: DataFrame) -> DataFrame:
    """The first has as many rows as the second, or more."""
    both = larger.agg(F.count(F.lit(1)).alias("x")).crossJoin(smaller.agg(F.count(F.lit(1)).alias("y")))
    status = F.when(F.col("x") >= F.col("y"), "pass").otherwise("fail")
    return both.select(F.lit(name).alias("check_name"), F.col("y").alias("expected"), F.col("x").alias("actual"), status.alias("status"))


def not_empty(name: str, df: DataFrame) -> DataFrame:
    return at_least(name, df, df.sparkSession.range(1))


def same_attributes(name: str, source: DataFrame, target: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Every source row is in the target with equal values; null equals null."""
    s = source.select(*keys, F.struct(*values).alias("_s"))
    t = target.select(*keys, F.struct(*values).alias("_t"), F.lit(True).alias("_there"))
    return none_of(name, s.join(t, keys, "left").where(F.col("_there").isNull() | ~F.col("_s").eqNullSafe(F.col("_t"))))
