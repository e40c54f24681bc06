"""Guarded tables: every row carries the digest it was written with, and every change leaves a stored receipt.

A change is planned from what is stored and what is wanted, and is refused if a stored row no longer gives its digest. Receipts (what
happened to which key, both digests, and the row as it was) are written beside the new rows; both are read back and compared before
the pointer moves. A rollback reads the receipts of the current snapshot from storage and takes the change back, if every row it
touched is still as the change left it; it leaves receipts of its own, so it can be taken back as well. A change that changes
nothing writes nothing. One writer at a time (see publish)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..storage import stored
from . import publish, quality

DIGEST = "output_sha256"
CHANGES = ("insert", "update", "delete")
INVERSE = {"insert": "delete", "delete": "insert", "update": "update"}


class Tampered(Exception):
    """Stored rows don't give the digest they were written with."""


class RollbackRefused(Exception):
    """Rows have changed since the change that was to be taken back."""


def digest(rows: DataFrame, stamp: str) -> Column:
    """Digest of all columns of a row but its stamp and its digest, by name; instants count in microseconds, whatever the session's zone."""
    named = sorted((f for f in rows.schema if f.name not in (DIGEST, stamp)), key=lambda f: f.name)
    value = lambda f: F.unix_micros(F.col(f"`{f.name}`")) if isinstance(f.dataType, TimestampType) else F.col(f"`{f.name}`")
    fields = [value(f).alias(f.name) for f in named]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def _packed(found: str | Column) -> Column:
    """A digest in half its bytes, for a shuffle."""
    return F.unhex(found)


def _unpacked(found: str | Column) -> Column:
    return F.lower(F.hex(found))


def _key(rows: DataFrame, keys: list[str], *columns: str | Column) -> DataFrame:
    """(_key, columns): keys as one struct, in which null equals null."""
    return rows.select(F.struct(*keys).alias("_key"), *columns)


def read(spark: SparkSession, root: str, name: str = "rows") -> DataFrame | None:
    """The current rows, or the receipts of the change that made them; None before the first change."""
    now = publish.current(spark, root)
    return publish.read_snapshot(spark, root, now, name) if now else None


def plan(before: DataFrame | None, incoming: DataFrame, keys: list[str], scope: Column | None = None, gone: DataFrame | None = None, stamp: str = "loaded_at") -> DataFrame:
    """keys, action, before_sha256, after_sha256, and `before` (the stored row, where it changes), `after` (the incoming one).

    Stored rows that are not incoming are deleted if the scope holds for them or `gone` lists their key, else left outside."""
    after = incoming.withColumn(DIGEST, digest(incoming, stamp)).withColumn(stamp, F.current_timestamp())
    if before is None:
        before = after.where(F.lit(False))
    columns = after.columns
    inside = F.coalesce(scope, F.lit(False)) if scope is not None else F.lit(False)
    # Rows travel without their time of loading and with packed digests; a stored digest that is not the row's travels as it is.
    bare = [c for c in columns if c not in (DIGEST, stamp)]
    held = before.withColumn("_sound", F.coalesce(digest(before, stamp) == F.col(DIGEST), F.lit(False)))
    written = F.when(F.col("_sound"), _packed(DIGEST)).alias("_written")
    s = _key(held, keys, F.struct(*bare, stamp).alias("_row"), written, F.when(~F.col("_sound"), F.col(DIGEST)).alias("_odd"), "_sound", inside.alias("_leaves"))
    if gone is not None:
        s = s.join(_key(gone, keys, F.lit(True).alias("_gone")).distinct(), "_key", "left").withColumn("_leaves", F.col("_leaves") | F.col("_gone").isNotNull())
    i = _key(after, keys, F.struct(*bare).alias("_new"), _packed(DIGEST).alias("_wanted"))
    action = (
        F.when(F.col("_row").isNull(), "insert")
        .when(~F.col("_sound"), "tampered")
        .when(F.col("_new").isNull(), F.when(F.col("_leaves"), "delete").otherwise("outside"))
        .when(F.col("_written") == F.col("_wanted"), "unchanged")
        .otherwise("update")
    )
    met = s.join(i, "_key", "full_outer").withColumn("action", action)
    changed = F.col("action").isin(*CHANGES)
    was, will = F.coalesce(_unpacked("_written"), F.col("_odd")), _unpacked("_wanted")
    part = lambda of, stamped, seal: F.struct(*[(seal if c == DIGEST else stamped if c == stamp else F.col(f"{of}.`{c}`")).alias(c) for c in columns])
    stored_row, new_row = part("_row", F.col(f"_row.`{stamp}`"), was), part("_new", F.current_timestamp(), will)
    return met.select(
        "_key.*", "action", was.alias("before_sha256"), F.when(F.col("action") != "delete", will).alias("after_sha256"),
        F.when(changed & F.col("_row").isNotNull(), stored_row).alias("before"), F.when(changed & F.col("_new").isNotNull(), new_row).alias("after"),
    )


def _gates(keys: list[str], stamp: str):
    """What the written snapshot must satisfy when it is read back."""

    def gates(read_back) -> DataFrame:
        rows, receipts = read_back("rows"), read_back("receipts")
        now = _key(rows, keys, _packed(DIGEST).alias("_now"))
        met = _key(receipts, keys, _packed("after_sha256").alias("after_sha256")).join(now, "_key", "left")
        return quality.report(
            quality.none_of("rows_give_their_digest", rows.where(~digest(rows, stamp).eqNullSafe(F.col(DIGEST)))),
            quality.unique_grain("one_row_a_key", rows, keys),
            quality.none_of("receipts_hold", met.where(~F.col("_now").eqNullSafe(F.col("after_sha256")))),
        )

    return gates


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn("_key", F.struct(*keys)).join(_key(others, keys), "_key", "left_anti").drop("_key")


RECEIPT = ("action", "before_sha256", "after_sha256", "before")


def apply(spark: SparkSession, root: str, incoming: DataFrame, keys: list[str], scope: Column | None = None, gone: DataFrame | None = None, stamp: str = "loaded_at", dry_run: bool = False) -> dict:
    """Make the table hold the incoming rows; gives the number of each action and the snapshot that is current afterwards."""
    now = publish.current(spark, root)
    before = publish.read_snapshot(spark, root, now, "rows") if now else None
    # The digests of what changes are in its rows, those of the rest aren't asked for again.
    planned = stored(plan(before, incoming, keys, scope, gone, stamp).drop("before_sha256", "after_sha256"), "guarded-plan")
    counts = {r["action"]: r["count"] for r in planned.groupBy("action").count().collect()}  # a row for each action
    if counts.get("tampered"):
        raise Tampered(f"{counts['tampered']} rows of {root}")
    changed = planned.where(F.col("action").isin(*CHANGES)).withColumns({"before_sha256": F.col(f"before.{DIGEST}"), "after_sha256": F.col(f"after.{DIGEST}")})
    if not dry_run and any(counts.get(a) for a in CHANGES):
        rows = changed.where("action <> 'delete'").select("after.*")
        if before is not None:
            rows = _without(before, changed, keys).select(*rows.columns).unionByName(rows)
        now = publish.publish(spark, root, {"rows": rows, "receipts": changed.select(*keys, *RECEIPT)}, _gates(keys, stamp), expected=now)
    return {**counts, "snapshot": now}


def rollback(spark: SparkSession, root: str, expected: str, keys: list[str], stamp: str = "loaded_at") -> dict:
    """Take back the change that made the current snapshot, which must be `expected`, from its stored receipts."""
    if publish.current(spark, root) != expected:
        raise RollbackRefused("the current snapshot is not the expected one")
    rows, receipts = (publish.read_snapshot(spark, root, expected, name) for name in ("rows", "receipts"))
    now = _key(rows, keys, _packed(digest(rows, stamp)).alias("_now"), F.struct(*rows.columns).alias("_row"))
    checked = stored(receipts.withColumn("_key", F.struct(*keys)).join(now, "_key", "left").drop("_key").withColumn("_now", _unpacked("_now")), "guarded-rollback")
    late = checked.where(~F.col("_now").eqNullSafe(F.col("after_sha256"))).count()
    if late:
        raise RollbackRefused(f"{late} rows have changed since")
    kept = _without(rows, receipts, keys).select(*rows.columns)
    restored = kept.unionByName(checked.where("before IS NOT NULL").select("before.*").select(*rows.columns))
    inverse = F.element_at(F.create_map(*[F.lit(x) for pair in INVERSE.items() for x in pair]), F.col("action"))
    undone = checked.select(*keys, inverse.alias("action"), F.col("after_sha256").alias("before_sha256"), F.col("before_sha256").alias("after_sha256"), F.col("_row").alias("before"))
    snapshot = publish.publish(spark, root, {"rows": restored, "receipts": undone}, _gates(keys, stamp), expected=expected)
    return {"undone": undone.count(), "snapshot": snapshot}
