"""Table synchronisation as pure functions of (stored, incoming): the result is the next snapshot of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sync_plan(stored: DataFrame, incoming: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys with `action`: insert, update, unchanged or delete; null equals null."""
    s = stored.select(*[F.col(k).alias(k) for k in keys], F.struct(*values).alias("_s"), F.lit(True).alias("_in_s"))
    i = incoming.select(*[F.col(k).alias(k) for k in keys], F.struct(*values).alias("_i"), F.lit(True).alias("_in_i"))
    action = (
        F.when(F.col("_in_s").isNull(), "insert").when(F.col("_in_i").isNull(), "delete").when(F.col("_s").eqNullSafe(F.col("_i")), "unchanged").otherwise("update")
    )
    return s.join(i, keys, "full_outer").select(*keys, action.alias("action"))


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], values: list[str], stamp: str) -> DataFrame:
    """Last writer wins by key; a row that did not change keeps its old time stamp."""
    s = stored.select(*keys, F.struct(*values).alias("_s"), F.col(stamp).alias("_ts"), F.lit(True).alias("_in_s"))
    i = incoming.select(*keys, F.struct(*values).alias("_i"), F.col(stamp).alias("_ti"), F.lit(True).alias("_in_i"))
    keep = F.col("_in_i").isNull() | (F.col("_in_s").isNotNull() & F.col("_s").eqNullSafe(F.col("_i")))
    row = F.when(keep, F.col("_s")).otherwise(F.col("_i"))
    return s.join(i, keys, "full_outer").withColumn("_row", row).select(*keys, "_row.*", F.when(keep, F.col("_ts")).otherwise(F.col("_ti")).alias(stamp))


def scd1(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Overwrite by key, add new keys, keep the rest."""
    return stored.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming)


def append_new(stored: DataFrame, incoming: DataFrame, grain: list[str]) -> DataFrame:
    """Stored rows and the incoming ones whose grain is not stored; running it again adds nothing."""
    return stored.unionByName(incoming.join(stored.select(*grain).distinct(), grain, "left_anti"))


def drop_rejected(stored: DataFrame, rejected: DataFrame, keys: list[str]) -> DataFrame:
    return stored.join(rejected.select(*keys).distinct(), keys, "left_anti")


def claim_first(registry: DataFrame, observed: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first observation of every key that the registry does not hold yet."""
    first = observed.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")
    return first.join(registry.select(key), key, "left_anti")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left beyond their number in right, as often as they exceed it."""
    return left.exceptAll(right)


def keep_ids(stored: DataFrame, wanted: DataFrame, values: list[str], id_col: str) -> DataFrame:
    """wanted with the stored ids of equal rows; the k-th of equal rows takes the k-th id, new rows have none."""
    number = lambda df, *order: df.withColumn("_rn", F.row_number().over(W.partitionBy(*values).orderBy(*order)))
    s = number(stored.select(*values, id_col), F.col(id_col))
    w = number(wanted.select(*values), F.lit(1))
    same = F.lit(True)
    for c in [*values, "_rn"]:
        same = same & w[c].eqNullSafe(s[c])
    return w.join(s, same, "left").select(*[w[c] for c in values], s[id_col])


# -- guarded synchronisation -------------------------------------------------------------------------------------
def digest_of(columns: list[str]) -> Column:
    """Digest of some columns: null and the empty text differ."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def guarded_plan(stored: DataFrame, incoming: DataFrame, keys: list[str], values: list[str], scope: Column | None = None) -> DataFrame:
    """keys, action and both digests. Stored rows carry `output_sha256`, the digest they were written with; a row whose values no
    longer give it has been tampered with. Only stored rows of the scope can be deleted."""
    inside = scope if scope is not None else F.lit(True)
    s = stored.select(*keys, digest_of(values).alias("now"), F.col("output_sha256").alias("written"), inside.alias("_inside"), F.lit(True).alias("_in_s"))
    i = incoming.select(*keys, digest_of(values).alias("after"), F.lit(True).alias("_in_i"))
    action = (
        F.when(F.col("_in_s").isNull(), "insert")
        .when(~F.col("now").eqNullSafe(F.col("written")), "tampered")
        .when(F.col("_in_i").isNull(), F.when(F.col("_inside"), "delete").otherwise("outside"))
        .when(F.col("now") == F.col("after"), "unchanged")
        .otherwise("update")
    )
    return s.join(i, keys, "full_outer").select(*keys, action.alias("action"), F.col("written").alias("before_sha256"), F.col("after").alias("after_sha256"))


def apply_plan(stored: DataFrame, incoming: DataFrame, plan: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The table after a plan: rows to insert and update with their new digest, deleted ones gone, the rest as stored."""
    of = lambda *actions: plan.where(F.col("action").isin(*actions)).select(*keys)
    columns = [*keys, *values, "output_sha256"]
    kept = stored.join(of("unchanged", "outside"), keys, "left_semi").select(*columns)
    changed = incoming.join(of("insert", "update"), keys, "left_semi").withColumn("output_sha256", digest_of(values)).select(*columns)
    return kept.unionByName(changed)


def undo(after: DataFrame, before: DataFrame, receipts: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(table, refused): the changes of a plan taken back from its receipts; a row that has changed since is refused and stays."""
    changed = receipts.where(F.col("action").isin("insert", "update", "delete"))
    now = after.select(*keys, F.col("output_sha256").alias("_now"))
    checked = changed.join(now, keys, "left")
    expected = F.when(F.col("action") == "delete", F.lit(None)).otherwise(F.col("after_sha256"))
    refused = checked.where(~F.col("_now").eqNullSafe(expected)).select(*keys)
    fine = checked.where(F.col("_now").eqNullSafe(expected)).select(*keys)
    return after.join(fine, keys, "left_anti").unionByName(before.join(fine, keys, "left_semi").select(*after.columns)), refused


def owner_conflicts(rows: DataFrame, key: str, natural: list[str]) -> DataFrame:
    """Natural values that two keys claim, or keys that claim two natural values."""
    owners = rows.select(key, *natural).distinct()
    several = owners.groupBy(*natural).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*natural, F.lit("natural_value_of_two_keys").alias("conflict"))
    split = owners.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in natural]).where("n > 1").select(*natural, F.lit("key_of_two_natural_values").alias("conflict"))
    return several.unionByName(split)


def set_changes(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows to insert and delete so that a table holds exactly the wanted set, with `action`."""
    w = wanted.select(*stored.columns)
    return w.subtract(stored).withColumn("action", F.lit("insert")).unionByName(stored.subtract(w).withColumn("action", F.lit("delete")))
