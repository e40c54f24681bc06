"""Pinned reads, cutover and chains of stages."""

from __future__ import annotations

import pytest
from gleaner.operators import cutover, publish, quality, stages
from pyspark.sql import functions as F


def put(spark, root, rows, schema="k int, company string"):
    return publish.publish(spark, root, {"facts": spark.createDataFrame(rows, schema)}, lambda read: quality.unique_grain("facts", read("facts"), ["k"]))


#: Both sides show the same view: the old one keeps null companies, the new one an unknown member.
OLD = {"jobs": lambda read: read("facts").select("k", F.coalesce("company", F.lit("")).alias("company"))}
NEW = {"jobs": lambda read: read("facts").select(F.when(F.col("company") == "Unknown", "").otherwise(F.col("company")).alias("company"), "k")}


def test_a_publish_in_the_middle_changes_nothing_that_a_run_reads(spark, tmp_path):
    root = f"file://{tmp_path}/dw"
    with pytest.raises(LookupError):
        cutover.Pinned.current(spark, root)
    put(spark, root, [(1, "a")])
    run = cutover.Pinned.current(spark, root)
    before = run.read("facts").collect()
    put(spark, root, [(1, "b"), (2, "c")])
    assert run.read("facts").collect() == before and cutover.Pinned.current(spark, root).read("facts").count() == 2


def test_consumers_move_only_to_equal_content(spark, tmp_path):
    old_root, new_root, consumers = (f"file://{tmp_path}/{n}" for n in ("old", "new", "bi"))
    put(spark, old_root, [(1, "a"), (2, None), (3, "c")])
    put(spark, new_root, [(1, "a"), (2, "Unknown"), (3, "d")])
    pin = lambda root: cutover.Pinned.current(spark, root)
    with pytest.raises(publish.PublishRejected, match="jobs_only_new"):
        cutover.cut_over(spark, consumers, pin(old_root), pin(new_root), OLD, NEW, expected=None)
    assert publish.current(spark, consumers) is None
    put(spark, new_root, [(3, "c"), (1, "a"), (2, "Unknown")])
    new = pin(new_root)
    put(spark, new_root, [(9, "later")])  # what the cutover has pinned stays as it was
    moved = cutover.cut_over(spark, consumers, pin(old_root), new, OLD, NEW, expected=None)
    assert publish.current(spark, consumers) == moved and {tuple(r) for r in cutover.Pinned.current(spark, consumers).read("jobs").select("k", "company").collect()} == {(1, "a"), (2, ""), (3, "c")}
    with pytest.raises(publish.PublishRejected):  # another consumer version has become current
        cutover.cut_over(spark, consumers, pin(old_root), new, OLD, NEW, expected=None)
    for views in ({}, {"jobs": lambda read: read("facts")}):
        with pytest.raises(ValueError):
            cutover.comparison(pin(old_root).read, new.read, OLD, {"jobs": lambda read: read("facts").select("k")} if views else {})


def test_repeated_rows_count_in_a_cutover(spark):
    side = lambda *rows: lambda name: spark.createDataFrame(list(rows), "k int, company string")
    same = {"jobs": lambda read: read("facts")}
    assert quality.all_pass(cutover.comparison(side((1, None), (1, None)), side((1, None), (1, None)), same, same))
    report = cutover.comparison(side((1, None), (1, None)), side((1, None)), same, same)
    assert {r["check_name"]: r["actual"] for r in report.collect()} == {"jobs_only_old": 1, "jobs_only_new": 0}


def test_a_chain_goes_on_after_its_last_finished_stage(spark, tmp_path):
    root, ran, broken = f"file://{tmp_path}/runs", [], [True]

    def stage(name, code=stages.DONE):
        def work():
            ran.append(name)
            if name == "second" and broken[0]:
                raise OSError("disk")
            return code

        return name, work

    chain = [stage("first", stages.SOME_REJECTED), stage("second"), stage("third")]
    with pytest.raises(stages.StageFailed, match="second"):
        stages.run_stages(spark, root, "r1", chain)
    assert ran == ["first", "second"] and set(stages.finished(spark, root, "r1")) == {"first"}
    broken[0] = False
    assert stages.run_stages(spark, root, "r1", chain) == stages.SOME_REJECTED and ran == ["first", "second", "second", "third"]
    assert stages.run_stages(spark, root, "r1", chain) == stages.SOME_REJECTED and len(ran) == 4
    assert stages.run_stages(spark, root, "r2", chain, only={"third"}) == stages.DONE and ran[4:] == ["third"]
    with pytest.raises(stages.StageFailed):
        stages.run_stages(spark, root, "r3", [("odd", lambda: 7)])
