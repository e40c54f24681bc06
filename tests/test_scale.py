"""Work that must be shared out, and what may be shuffled, whatever the size of the input."""

from __future__ import annotations

import re

import duckdb
from pyspark.sql import functions as F

from gleaner import storage
from gleaner.functions import rules
from gleaner.operators import atomize, guarded, star_load
from gleaner.plans import model, postings, registry, views, warehouse


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_are_dealt_out_over_all_cores(spark, sf_dir):
    """A small file of parts is one task, each of its rows a whole posting to normalise."""
    assert postings.t(spark, sf_dir, "part").rdd.getNumPartitions() == 1
    rows = postings.raw_postings(spark, sf_dir)
    sizes = rows.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()
    assert len(sizes) >= 4 * spark.sparkContext.defaultParallelism and max(sizes) <= 2 * sum(sizes) / len(sizes) + 10


def test_atoms_are_dealt_out_once_by_observation(spark, sf_dir):
    """The entries of an observation stay together: none of their long keys is shuffled again to make them distinct."""
    values, issues = atomize.atomize_records(model.records(spark, sf_dir))
    for df in (values, issues):
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(df))
        assert [x for x in dealt if "observation_key" in x] and not [x for x in dealt if "value_key" in x or "issue_key" in x]


def test_a_first_load_shuffles_nothing_against_empty_tables(spark, sf_dir):
    before, observed, values = model._loaded(spark, sf_dir)
    assert all(before[n].schema[c.split()[0]].dataType.simpleString() for n, (ddl, _) in star_load.TABLES.items() for c in ddl.split(", "))
    after = star_load.load(before, observed, values)
    assert "Anti" not in plan_of(after["fact_job_necessary_skill"]) and "Join" not in plan_of(after["fact_job_observation"])


def test_each_spelling_of_a_skill_is_read_once(spark, sf_dir):
    plan = plan_of(registry.QUERIES["skill_alias_category"](spark, sf_dir))
    below = plan[plan.index("Generate") :]
    assert "HashAggregate" in below and "isin" not in below


def test_a_plan_moves_no_digest_as_text(spark):
    """Neither the digests of stored rows nor those of incoming ones cross the join in their hexadecimal form."""
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k int, v string")
    stored = guarded.plan(None, before, ["k"]).select("after.*")
    stored = spark.createDataFrame([(r["k"], "changed" if r["k"] == 4 else r["v"], "odd" if r["k"] == 3 else r["output_sha256"], r["loaded_at"]) for r in stored.collect()], stored.schema)
    planned = guarded.plan(stored, spark.createDataFrame([(1, "a"), (2, "x"), (3, "c"), (5, "e")], "k int, v string"), ["k"])
    found = {r["k"]: r for r in planned.collect()}
    assert {k: r["action"] for k, r in found.items()} == {1: "unchanged", 2: "update", 3: "tampered", 4: "tampered", 5: "insert"}
    assert found[3]["before_sha256"] == "odd" and found[2]["before"]["output_sha256"] == found[2]["before_sha256"] and found[2]["after"]["v"] == "x"
    assert found[5]["before"] is None and found[1]["before_sha256"] == found[1]["after_sha256"] and len(found[1]["after_sha256"]) == 64
    assert "unhex" in plan_of(planned)


def test_references_without_a_semicolon_in_page_text(spark, tmp_path):
    """HTML reads &amp without its semicolon; the SQL beside the query does as well."""
    html = '<p>a &amp&amp; b&amp</p><ul><li>&copy 1</li><li>&quotx&quot;</li></ul><p>&amp;quot; &middot</p>'
    spark.createDataFrame([(1, html)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.QUERIES["rich_text"](spark, f"file://{tmp_path}").first()["text"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert con.sql(registry.ORACLES["rich_text"]).fetchall()[0][1] == got == 'a && b&\n- © 1\n- "x"\n&quot; ·'


def test_language_scans_a_text_no_more_than_it_must(spark):
    """Letters are counted only for texts that hold signs of other scripts; what is decided stays the same."""
    texts = ["", "123", "ab", "the job", "Ăn Ân", "ăn", "ab при", "ab прив", "прив" + "a" * 40, "va voi", "va voi the and", "les une avec", "les une avec the and", "công việc và yêu cầu", None, "<b>прив</b>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, s string").select("n", rules.posting_language(F.col("s")).alias("x"))
    assert [r["x"] for r in rows.orderBy("n").collect()] == ["unknown", "unknown", "unknown", "en", "vi", "unknown", "unknown", "other", "en", "vi", "en", "other", "en", "vi", "unknown", "other"]
    assert plan_of(rows).count("lower(") == plan_of(rows).count("split(") == 1


def test_lines_are_dealt_out_by_their_number(spark, sf_dir, monkeypatch):
    """What is sorted, made distinct or counted by order or job is dealt out by the number of lines, not by the session's partitions."""
    assert storage.partitions(spark.range(1000), 100) == 10 and storage.partitions(spark.range(1000), 10**6) == 4
    for module in (views, warehouse):
        monkeypatch.setattr(module, "partitions", lambda rows: 37)
    for name in ("skill_demand_daily", "view_dw_job_role_city", "view_dw_job_core_skill", "view_bridge_framework_latest"):
        plan = plan_of(registry.QUERIES[name](spark, sf_dir))
        dealt = re.findall(r"hashpartitioning\((l_orderkey|observation_key|job_id)#\w+, .*?(\d+)\)", plan)
        by_line = [n for key, n in dealt if name != "view_bridge_framework_latest" or key != "job_id"]
        assert by_line and set(by_line) == {"37"}, (name, dealt)
        below = plan[plan.rindex("HashAggregate(") : plan.index("FileScan", plan.rindex("HashAggregate("))]
        assert "REPARTITION_BY_NUM" in below, name


def test_a_retracting_load_shuffles_each_fact_once(spark, sf_dir):
    """What a load takes out and puts in is decided within an observation: facts are dealt out by job and run, and never by their grain."""
    rows = model.records(spark, sf_dir).limit(20)
    values = storage.stored(atomize.atomize_records(rows)[0], "v")
    observed = storage.stored(atomize.observations(rows, values), "o")
    first = {n: storage.stored(df, n) for n, df in star_load.load(star_load.bootstrap(spark), observed, values, retract=True).items()}
    again = star_load.load(first, observed, values.where("group <> 'city'"), retract=True)
    for df in (again["fact_job_necessary_skill"], again["fact_job_role_city"]):
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(df))
        assert [x for x in dealt if x.startswith("job_key")] and not [x for x in dealt if x.startswith("job_key") and x.count("#") > 2]
    changes = star_load.fact_changes(first, again)
    assert all(x.count("#") == 2 for x in re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(changes)) if x.startswith("job_key"))
    assert {r["table"] for r in changes.collect()} == {"fact_job_role_city"}
