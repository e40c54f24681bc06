from __future__ import annotations

import pytest
from gleaner.operators import latest, publish, quality, star, sync
from pyspark.sql import functions as F


def test_latest_breaks_ties_by_later_columns(spark):
    rows = spark.createDataFrame([("j", 1, "run_a"), ("j", 2, "run_b"), ("j", 2, "run_c")], "job string, at int, run string")
    assert [r["run"] for r in latest.latest_by(rows, ["job"], "at", "run").collect()] == ["run_c"]


def test_context_numbers_start_with_null(spark):
    rows = spark.createDataFrame([("j", "B2"), ("j", None)], "job string, level string")
    assert {(r["level"], r["context_no"]) for r in latest.context_numbers(rows, ["job"], "level").collect()} == {(None, 0), ("B2", 1)}


def test_demand_share(spark):
    jobs = spark.createDataFrame([(1, "dev"), (2, "dev"), (3, "dev")], "job int, role string")
    skills = spark.createDataFrame([(1, "Java"), (2, "Java")], "job int, skill string")
    row = star.two_level_demand(skills, jobs, "job", "role", "skill").first()
    assert (row["skill_jobs"], row["role_jobs"], row["skill_percent"]) == (2, 3, 66.67)


def test_combinations_keep_facts_without_values(spark):
    facts = spark.createDataFrame([(1,), (2,)], "job int")
    roles = spark.createDataFrame([(1, "a"), (1, "b")], "job int, role string")
    cities = spark.createDataFrame([(1, "x"), (1, "y")], "job int, city string")
    assert star.combinations(facts, roles, cities, "job").count() == 5


def test_dimension_has_unknown_member_and_stable_keys(spark):
    rows = spark.createDataFrame([("a", "A"), ("a", "a"), (None, None)], "natural string, shown string")
    first, again = (star.dimension(rows, ["natural"], "k", ["shown"]).collect() for _ in range(2))
    assert sorted(map(tuple, first)) == sorted(map(tuple, again)) and {r["natural"] for r in first} == {"a", "Unknown"}


def test_sync_is_idempotent(spark):
    stored = spark.createDataFrame([(1, "x", 10), (2, "y", 10)], "k int, v string, at int")
    incoming = spark.createDataFrame([(2, "y", 20), (3, None, 20)], "k int, v string, at int")
    once = sync.upsert(stored, incoming, ["k"], ["v"], "at")
    assert {tuple(r) for r in once.collect()} == {(1, "x", 10), (2, "y", 10), (3, None, 20)}
    assert {tuple(r) for r in sync.upsert(once, incoming, ["k"], ["v"], "at").collect()} == {tuple(r) for r in once.collect()}
    assert {tuple(r) for r in sync.sync_plan(stored, incoming, ["k"], ["v"]).collect()} == {(1, "delete"), (2, "unchanged"), (3, "insert")}
    grown = sync.append_new(stored, incoming, ["k"])
    assert sync.append_new(grown, incoming, ["k"]).count() == grown.count() == 3


def test_keep_ids_matches_equal_rows_by_number(spark):
    stored = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "v string, id int")
    wanted = spark.createDataFrame([("a",), ("a",), ("a",), (None,)], "v string")
    found = [(r["v"], r["id"]) for r in sync.keep_ids(stored, wanted, ["v"], "id").collect()]
    assert sorted(found, key=str) == sorted([("a", 1), ("a", 2), ("a", None), (None, 3)], key=str)


def test_gates_find_mutations(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert quality.all_pass(quality.report(quality.same_rows("rows", a, a), quality.unique_grain("grain", a, ["k"])))
    changed = a.withColumn("v", F.coalesce("v", F.lit("")))
    assert not quality.all_pass(quality.same_rows("rows", a, changed))
    assert not quality.all_pass(quality.unique_grain("grain", a.union(a), ["k"]))


def test_publish_and_rollback(spark, tmp_path):
    root = f"file://{tmp_path}/dw"
    facts = spark.range(3).withColumnRenamed("id", "k")
    gates = lambda read: quality.unique_grain("grain", read("facts"), ["k"])
    first = publish.publish(spark, root, {"facts": facts}, gates)
    second = publish.publish(spark, root, {"facts": facts.union(spark.range(3, 5))}, gates)
    assert publish.current(spark, root) == second
    with pytest.raises(publish.PublishRejected):
        publish.publish(spark, root, {"facts": facts.union(facts)}, gates)
    assert publish.current(spark, root) == second
    assert publish.rollback(spark, root, second) == first == publish.current(spark, root)
