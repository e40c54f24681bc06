"""Commands: normalize, analytics, warehouse, pipeline (these three in a chain), rollback. Each shows what it would do unless told to --apply, and ends with a code:
0 done, 2 some records rejected, 4 storage. Paths stand in for connections."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import atomize, contract, guarded, normalize, publish, stages, star_load, views
from .session import build_session
from .storage import stored

DONE, SOME_REJECTED, STORAGE = 0, 2, 4
RECORD_KEYS = ["job_id", "crawl_run_id"]


def _postings(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Raw postings of a scope, in order of arrival; a limit is a request of the user."""
    rows = views.scope(spark.read.parquet(args.input), source=args.source, crawl_run_id=args.crawl_run_id)
    return rows.orderBy("observed_at", "job_id").limit(args.limit) if args.limit else rows


def normalize_command(spark: SparkSession, args: argparse.Namespace) -> int:
    """Upserts records that differ from what is stored and deletes stored ones that are rejected now, so a rerun writes nothing."""
    records = stored(normalize.normalized(_postings(spark, args)), "command-normalized")
    counts = {r["outcome"]: r["n"] for r in normalize.outcome_counts(records).collect()}
    rows = normalize.persisted(records).withColumn("normalization_version", F.lit(contract.STORAGE_VERSION))
    gone = records.where("reject_reason IS NOT NULL AND job_id IS NOT NULL AND crawl_run_id IS NOT NULL")
    changes = guarded.apply(spark, args.output, rows, RECORD_KEYS, gone=gone, stamp="normalized_at", dry_run=not args.apply)
    print(json.dumps({"dry_run": not args.apply, "outcomes": counts, "changes": changes}, sort_keys=True))
    return SOME_REJECTED if set(counts) - {"normalized"} else DONE


def _records(spark: SparkSession, path: str) -> DataFrame:
    """What the normalize command keeps, or a plain table of records."""
    kept = guarded.read(spark, path)
    return spark.read.parquet(path) if kept is None else kept


def analytics_command(spark: SparkSession, args: argparse.Namespace) -> int:
    """Brings the atomized outputs of a scope up to date; outputs of the scope whose record is gone are deleted."""
    records = views.scope(_records(spark, args.input), source=args.source, crawl_run_id=args.crawl_run_id)
    scope = F.lit(True)
    for column, wanted in (("source", args.source), ("crawl_run_id", args.crawl_run_id)):
        scope = scope & (F.col(column) == wanted) if wanted else scope
    found = stored(atomize.outputs(records), "command-outputs")
    changes = guarded.apply(spark, args.output, found, ["observation_key"], scope=scope, dry_run=not args.apply)
    print(json.dumps({"dry_run": not args.apply, "observations": found.count(), "review_items": atomize.issues_of(found).count(), "changes": changes}, sort_keys=True))
    return DONE


def warehouse_command(spark: SparkSession, args: argparse.Namespace) -> int:
    """Loads the newest record of each job; with --all-observations every record."""
    records = _records(spark, args.input)
    records = records if args.all_observations else views.latest.latest_by(records, ["job_id"], "observed_at", "crawl_run_id")
    now = publish.current(spark, args.output)
    before = {n: publish.read_snapshot(spark, args.output, now, n) for n in star_load.TABLES} if now else star_load.bootstrap(spark)
    values = stored(atomize.atomize_records(records)[0], "command-atoms")
    after = star_load.load(before, stored(atomize.observations(records, values), "command-observations"), values, retract=args.retract)
    print(json.dumps({"dry_run": not args.apply, "added": {r["table"]: r["rows_added"] for r in star_load.added(before, after).collect()}}, sort_keys=True))
    if args.apply:
        publish.publish(spark, args.output, after, star_load.gates, expected=now)
    return DONE


def rollback_command(spark: SparkSession, args: argparse.Namespace) -> int:
    """Takes back the last change of a guarded table from its receipts; of other tables, moves the pointer back."""
    keys = {"normalize": (RECORD_KEYS, "normalized_at"), "analytics": (["observation_key"], "loaded_at")}.get(args.table)
    done = guarded.rollback(spark, args.output, args.expected, *keys) if keys else {"snapshot": publish.rollback(spark, args.output, args.expected)}
    print(json.dumps({"current": done["snapshot"]}))
    return DONE


def pipeline_command(spark: SparkSession, args: argparse.Namespace) -> int:
    """normalize, analytics and warehouse, one after another, under one run name; a run that stopped goes on after its last finished stage."""
    of = lambda **changes: argparse.Namespace(**{"source": args.source, "crawl_run_id": None, "limit": None, "all_observations": False, "retract": args.retract, "apply": True} | changes)
    records, outputs, star = (f"{args.output}/{name}" for name in ("records", "analytics", "warehouse"))
    steps = [
        ("normalize", lambda: normalize_command(spark, of(input=args.input, output=records))),
        ("analytics", lambda: analytics_command(spark, of(input=records, output=outputs))),
        ("warehouse", lambda: warehouse_command(spark, of(input=records, output=star))),
    ]
    if not args.apply:
        print(json.dumps({"dry_run": True, "run": args.run, "finished": sorted(stages.finished(spark, f"{args.output}/runs", args.run)), "stages": [name for name, _ in steps]}))
        return DONE
    return stages.run_stages(spark, f"{args.output}/runs", args.run, steps)


COMMANDS = {"normalize": normalize_command, "analytics": analytics_command, "warehouse": warehouse_command, "pipeline": pipeline_command, "rollback": rollback_command}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gleaner")
    sub = top.add_subparsers(dest="command", required=True)
    for name in COMMANDS:
        one = sub.add_parser(name)
        one.add_argument("--output", required=True)
        if name == "rollback":
            one.add_argument("--expected", required=True, help="the snapshot that must be current")
            one.add_argument("--table", choices=["normalize", "analytics", "warehouse"], default="warehouse", help="whose output it is")
            continue
        one.add_argument("--input", required=True)
        one.add_argument("--apply", action="store_true")
        if name in ("normalize", "analytics", "pipeline"):
            one.add_argument("--source")
        if name in ("normalize", "analytics"):
            one.add_argument("--crawl-run-id")
        if name == "pipeline":
            one.add_argument("--run", required=True, help="name of the run; the same name goes on with a run that stopped")
        if name == "normalize":
            one.add_argument("--limit", type=int)
        if name in ("warehouse", "pipeline"):
            one.add_argument("--retract", action="store_true", help="facts of these observations that their records no longer give are deleted")
        if name == "warehouse":
            one.add_argument("--all-observations", action="store_true", help="every record, not the newest of each job alone")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return COMMANDS[args.command](spark or build_session(), args)
    except (publish.PublishRejected, guarded.Tampered, guarded.RollbackRefused, stages.StageFailed) as rejected:
        print(json.dumps({"rejected": str(rejected)}), file=sys.stderr)
        return STORAGE


if __name__ == "__main__":
    sys.exit(main())
