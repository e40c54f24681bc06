"""A chain of stages that can be taken up again: each finished stage leaves an entry in a manifest, a failure stops the chain, and the
next run with the same name goes on after the last stage that finished."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Exit codes: all done, some records rejected, a stage failed.
DONE, SOME_REJECTED, FAILED = 0, 2, 4


class StageFailed(Exception):
    """A stage raised an error; the stages before it are kept."""


def finished(spark: SparkSession, root: str, run: str) -> dict[str, dict]:
    """Entries of the finished stages of a run, by stage."""
    try:
        rows = spark.read.text(f"{root}/run={run}").collect()  # one small row a stage
    except Exception as error:  # nothing has finished yet
        if "PATH_NOT_FOUND" in str(error):
            return {}
        raise
    return {e["stage"]: e for e in (json.loads(r[0]) for r in rows)}


def run_stages(spark: SparkSession, root: str, run: str, stages: list[tuple[str, Callable[[], int]]], only: set[str] | None = None) -> int:
    """Run the stages in order; each gives DONE or SOME_REJECTED. Finished ones are passed over; the code of the run is the worst of all."""
    done = finished(spark, root, run)
    worst = max([e["code"] for e in done.values()], default=DONE)
    for name, stage in stages:
        if name in done or (only is not None and name not in only):
            continue
        try:
            code = stage()
        except Exception as error:
            raise StageFailed(f"{run}: stage {name} failed after {sorted(done)}") from error
        if code not in (DONE, SOME_REJECTED):
            raise StageFailed(f"{run}: stage {name} ended with {code}")
        done[name] = {"stage": name, "code": code, "at": datetime.now(UTC).isoformat()}
        spark.range(1).select(F.lit(json.dumps(done[name])).alias("value")).coalesce(1).write.mode("append").text(f"{root}/run={run}")
        worst = max(worst, code)
    return worst
