"""Pinned reads and cutover: a run reads one snapshot from beginning to end, and consumers move to a new one only when it says the same.

A publish in the middle of a run changes nothing that the run reads, since snapshots never change and a Pinned handle keeps its number. A
cutover compares what consumers see, column by column and both ways, before their pointer moves; where the two differ, the pointer
stays and the difference is told."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import publish, quality


@dataclass(frozen=True)
class Pinned:
    """One snapshot of a root, whatever becomes current later."""

    spark: SparkSession
    root: str
    snapshot: str

    @classmethod
    def current(cls, spark: SparkSession, root: str) -> Pinned:
        now = publish.current(spark, root)
        if now is None:
            raise LookupError(f"nothing has been published under {root}")
        return cls(spark, root, now)

    def read(self, name: str) -> DataFrame:
        return publish.read_snapshot(self.spark, self.root, self.snapshot, name)


#: What consumers see of a side: a view's name and how it is made from the side's tables.
Views = dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]]


def comparison(old: Callable[[str], DataFrame], new: Callable[[str], DataFrame], old_views: Views, new_views: Views) -> DataFrame:
    """A report: every view must have the same columns, and the same rows as often, on both sides."""
    if set(old_views) != set(new_views):
        raise ValueError(f"views of one side alone: {sorted(set(old_views) ^ set(new_views))}")
    checks = []
    for name in sorted(old_views):
        a, b = old_views[name](old), new_views[name](new)
        if sorted(a.columns) != sorted(b.columns):
            raise ValueError(f"{name}: columns of one side alone: {sorted(set(a.columns) ^ set(b.columns))}")
        b = b.select(*a.columns)
        checks += [quality.none_of(f"{name}_only_old", a.exceptAll(b)), quality.none_of(f"{name}_only_new", b.exceptAll(a))]
    return quality.report(*checks)


def cut_over(spark: SparkSession, consumers: str, old: Pinned, new: Pinned, old_views: Views, new_views: Views, expected=publish.ANY) -> str:
    """Publish the views of the new side for the consumers if they equal those of the old side; else PublishRejected, and nothing moves."""
    report = comparison(old.read, new.read, old_views, new_views)
    failed = {r["check_name"]: r["actual"] for r in report.where("status <> 'pass'").collect()}
    if failed:
        raise publish.PublishRejected(f"old and new differ: {failed}")
    tables = {name: make(new.read) for name, make in new_views.items()}
    return publish.publish(spark, consumers, tables, lambda read: quality.report(*[quality.same_rows(f"{n}_read_back", tables[n], read(n)) for n in tables]), expected=expected)
