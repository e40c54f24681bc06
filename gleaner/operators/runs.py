"""Crawl runs: identity, progress, outcome, and the JSON files that a run leaves behind."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import first_by


def new_run_id(source: str) -> str:
    """source_time_random."""
    return f"{source}_{datetime.now(timezone.utc):%Y%m%dT%H%M%S}_{uuid.uuid4().hex}"


def finish_status(source: Column, failed: Column, interrupted: Column, requested: Column, collected: Column, n_errors: Column) -> Column:
    """How a run ended. The precedence differs by source: one reports a failure before an interruption, the other after it."""
    broken, cut = F.when(failed, "failed"), F.when(interrupted, "interrupted")
    first = F.when(source == "itviec", F.coalesce(cut, broken)).otherwise(F.coalesce(broken, cut))
    return F.coalesce(first, F.when((n_errors > 0) & (collected == 0), "failed"), F.when((n_errors > 0) | (collected < requested), "partial"), F.lit("succeeded"))


def merge_progress(stored: DataFrame, reports: DataFrame, run: str = "crawl_run_id", at: str = "reported_at") -> DataFrame:
    """The last report of each run wins."""
    return first_by(stored.unionByName(reports.select(*stored.columns)), [run], [F.col(at).desc()])


def exit_code(storage_failed: Column, interrupted: Column, requested: Column, collected: Column, n_errors: Column) -> Column:
    """4 storage, 130 interrupted, 0 complete or without errors, 2 partial, 1 nothing."""
    return F.when(storage_failed, 4).when(interrupted, 130).when((collected >= requested) | (n_errors == 0), 0).when(collected > 0, 2).otherwise(1)


def write_json(records: DataFrame, root: str, run_id: str, identity: str = "job_id", at: str = "observed_at") -> None:
    """The last record of each identity as JSON lines, for the run and as the latest; Spark's committer makes each appear whole."""
    last = first_by(records, [identity], [F.col(at).desc()])
    last.write.mode("overwrite").json(f"{root}/run={run_id}")
    records.sparkSession.read.schema(last.schema).json(f"{root}/run={run_id}").write.mode("overwrite").json(f"{root}/latest")
