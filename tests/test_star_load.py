"""Atoms, the star load, guarded synchronisation, streaming tables and commands."""

from __future__ import annotations

import datetime as dt
import hashlib
import json

import pytest
from gleaner import commands
from gleaner.functions import dictionaries
from gleaner.operators import atomize, guarded, publish, quality, star_load, sync, views
from gleaner.storage import stored
from gleaner.streaming import jobs
from pyspark.sql import functions as F

from tests.test_normalize import COLUMNS, itviec, topdev

SCHEMA = (
    "job_id string, source string, source_job_id string, job_url string, crawl_run_id string, observed_at timestamp, title string, company_name string, description string, "
    "location_text string, work_mode string, job_roles array<string>, cities array<string>, seniority_levels array<string>, soft_skills array<string>, skills array<struct<name:string,category:string>>, "
    "foreign_languages array<struct<language:string,level_text:string>>, normalization_version string, normalized_at timestamp"
)


def record(job="topdev:1", run="run-1", day=1, **changes):
    base = {
        "job_id": job, "source": job.split(":")[0], "source_job_id": job.split(":")[1], "job_url": f"https://x.vn/{job}", "crawl_run_id": run, "observed_at": dt.datetime(2026, 1, day), "title": "Dev",
        "company_name": " Beta ", "description": "d", "location_text": None, "work_mode": None, "job_roles": ["Tester"], "cities": ["HCMC"], "seniority_levels": ["Senior"], "soft_skills": [], "skills": [],
        "foreign_languages": [("unknown", None)], "normalization_version": "5.1", "normalized_at": dt.datetime(2026, 1, day),
    } | changes
    return tuple(base.values())


def atoms(spark, *rows):
    values, issues = atomize.atomize_records(spark.createDataFrame(list(rows), SCHEMA))
    return {(r["group"], r["name"], r["category"], r["level_text"]) for r in values.collect()}, {(r["field_name"], r["source_value"], r["reason"]) for r in issues.collect()}


#: A skill, the atoms it gives, and the issue it leaves.
SKILL_CASES = [
    (("Java/React", "other"), {("programming_language", "Java"), ("framework", "React")}, None), (("C/C++", "x"), {("programming_language", "C"), ("programming_language", "C++")}, None),
    (("CI/CD", "devops"), {("core_skill", "CI/CD")}, None), (("UI/UX", "design"), {("core_skill", "UI/UX")}, None), (("Java và React", "other"), {("programming_language", "Java"), ("framework", "React")}, None),
    (("InternalFoo/Bar", "tool"), set(), ("core_skill", "InternalFoo/Bar", "unresolved_composite")), (("Fintech", "other"), set(), ("skills", "Fintech", "business_domain_not_a_skill")),
    (("English", "other"), {("foreign_language", "English")}, ("skills", "English", "foreign_language_tag_moved")), (("Tester", "other"), set(), ("skills", "Tester", "role_tag_moved")),
    (("Mystery", "other"), {("core_skill", "Mystery")}, ("skills", "Mystery", "category_needs_review")),
]


def test_atoms_of_skills(spark):
    frame = spark.createDataFrame([record(f"topdev:{k}", skills=[skill]) for k, (skill, _, _) in enumerate(SKILL_CASES)], SCHEMA)
    values, issues = atomize.atomize_records(frame)
    case = {hashlib.sha256(f'["topdev:{k}","run-1"]'.encode()).hexdigest(): k for k in range(len(SKILL_CASES))}
    found, told = [set() for _ in SKILL_CASES], [set() for _ in SKILL_CASES]
    for r in values.collect():
        found[case[r["observation_key"]]].add((r["group"], r["name"]))
    for r in issues.collect():
        told[case[r["observation_key"]]].add((r["field_name"], r["source_value"], r["reason"]))
    for k, (_, want, issue) in enumerate(SKILL_CASES):
        assert found[k] - {("role", "Tester"), ("city", "Hồ Chí Minh"), ("level", "Senior")} == want
        assert told[k] - {("foreign_languages", "unknown", "source_did_not_specify_language")} == ({issue} if issue else set())


def test_language_twice_and_bad_records(spark):
    found, _ = atoms(spark, record(skills=[("English", "other")], foreign_languages=[("English", "TOEIC 650")]))
    assert {(n, level) for g, n, _, level in found if g == "foreign_language"} == {("English", None), ("English", "TOEIC 650")}
    bad = [record(normalization_version="4.0"), record(job_roles=[]), record(foreign_languages=[]), record(job_id="itviec:1"), record(work_mode="moon"), record(observed_at=None)]
    assert atoms(spark, *bad) == (set(), set())
    one = spark.createDataFrame([record()], SCHEMA)
    key = atomize.observations(one, atomize.atomize_records(one)[0]).first()
    assert key["observation_key"] == hashlib.sha256(b'["topdev:1","run-1"]').hexdigest() and key["foreign_language_status"] == "unknown"


def test_atoms_of_odd_entries(spark):
    """Null and blank entries, composed and decomposed letters, width forms, repeated entries and empty parts."""
    decomposed = "Ha\u0300 No\u0323\u0302i"
    found, told = atoms(spark, record(cities=["Hà Nội", decomposed, " ", None, "ＨＣＭＣ"], skills=[("Java", "x"), ("java ", "y"), ("ＪＳ", "x"), ("Java/", "x"), (None, "x"), ("Odd  Name", None)]))
    assert {n for g, n, _, _ in found if g == "city"} == {"Hà Nội", "Hồ Chí Minh"}
    assert {(g, n, c) for g, n, c, _ in found if g in dictionaries.SKILL_ATOM_GROUPS} == {("programming_language", "Java", "programming_language"), ("programming_language", "JavaScript", "programming_language"), ("core_skill", "Odd Name", "")}
    assert ("core_skill", "Java/", "unresolved_composite") in told
    assert atoms(spark, record(cities=None, skills=None, soft_skills=None)) [0] >= {("role", "Tester", "", None)}


def test_skills_found_in_two_groups(spark):
    """The last group names a skill, the first one that knows the name owns it."""
    catalogue = {"programming_language": [("Go", "programming_language", ["Golang"])], "framework": [], "core_skill": [("Go", "game", ["go!"]), ("Chess", "game", [])], "role": [("Tester", None, [])], "city": [], "business_domain": []}
    values, _ = atomize.atomize_records(spark.createDataFrame([record(skills=[("go!", "x"), ("Chess/Golang", "x")])], SCHEMA), catalogue)
    assert {(r["group"], r["name"], r["category"]) for r in values.collect() if "Tester" not in r["name"]} >= {("programming_language", "Go", "programming_language"), ("core_skill", "Chess", "game")}


def test_catalogues():
    with pytest.raises(dictionaries.CatalogueConflict):
        dictionaries.spellings([("A", None, ["x"]), ("B", None, ["X"])])
    read = dictionaries.read_catalogue('{"city": [{"name": "Huế", "aliases": ["Hue"]}]}')
    assert read == {"city": [("Huế", None, ["Hue"])]} and {key for key, *_ in dictionaries.catalogue_rows(read)} == {"huế", "hue"}
    listed = "# t\n- **Architect**\n## 2. Data\n- **Data Engineer**\n* Data Analyst\ntext\n - **Data Analyst**\n## QA\n- **Tester**\n- Plain\n"
    assert dictionaries.read_role_names(listed) == {"Architect": "Uncategorized", "Data Engineer": "Data", "Data Analyst": "Data", "Tester": "QA"}
    with pytest.raises(ValueError):
        dictionaries.role_keywords(["Tester"], {"Unknown": ("x",)})


def loaded(spark, before, *rows):
    frame = spark.createDataFrame(list(rows), SCHEMA)
    values = stored(atomize.atomize_records(frame)[0], "t")
    after = star_load.load(before, stored(atomize.observations(frame, values), "t"), values)
    after = {n: stored(df, "t") for n, df in after.items()}
    return after, {r["table"]: r["rows_added"] for r in star_load.added(before, after).collect()}


def test_star_load_twice(spark):
    first = [
        record(skills=[("Java", "x"), ("React", "x")], foreign_languages=[("English", "TOEIC 650"), ("English", None)], job_roles=["Tester", "Data Engineer"], cities=["HCMC", "Ha Noi"]),
        record("topdev:2", cities=[], company_name=None),
    ]
    one, n = loaded(spark, star_load.bootstrap(spark), *first)
    assert (n["fact_job_observation"], n["fact_job_necessary_skill"], n["fact_job_role_city"]) == (2, 4, 5)
    assert (n["dim_job"], n["dim_company"], n["dim_city"], n["dim_proficiency_level"], n["dim_crawl_run"], n["dim_date"]) == (2, 1, 2, 1, 1, 1)
    assert quality.all_pass(star_load.gates(one.__getitem__))
    assert {r["context_no"] for r in one["fact_job_necessary_skill"].where("level_text_snapshot = 'TOEIC 650'").collect()} == {1}
    assert one["fact_job_role_city"].where("city_key = 0").count() == 1 and one["fact_job_observation"].where("company_key = 0").count() == 1
    again, n = loaded(spark, one, *first)
    assert set(n.values()) == {0}
    late, n = loaded(spark, one, record(run="run-0", day=1, observed_at=dt.datetime(2025, 12, 1)))
    assert n["fact_job_observation"] == 1 and n["dim_job"] == 0
    job = late["dim_job"].where("job_id = 'topdev:1'").first()
    assert (job["first_seen_at_utc"], job["last_seen_at_utc"]) == (dt.datetime(2025, 12, 1), dt.datetime(2026, 1, 1))
    right = hashlib.sha256("topdev:1|run-1".encode("utf-16le")).hexdigest().upper()
    assert late["fact_job_observation"].where(F.col("observation_id") == right).count() == 1
    broken = {**late, "fact_job_observation": late["fact_job_observation"].withColumn("observation_id", F.lit("wrong"))}
    assert not quality.all_pass(star_load.gates(broken.__getitem__))
    repaired = star_load.repaired(broken["fact_job_observation"], late["fact_job_observation"])
    assert repaired.where(F.col("observation_id") == right).count() == 1


def test_guarded_plan_apply_and_undo(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "k int, v string, src string").withColumn("output_sha256", sync.digest_of(["v", "src"]))
    incoming = spark.createDataFrame([(1, "a", "x"), (2, "B", "x"), (4, "d", "x")], "k int, v string, src string")
    plan = stored(sync.guarded_plan(base, incoming, ["k"], ["v", "src"], F.col("src") == "x"), "plan")
    assert {r["k"]: r["action"] for r in plan.collect()} == {1: "unchanged", 2: "update", 3: "outside", 4: "insert"}
    after = stored(sync.apply_plan(base, incoming, plan, ["k"], ["v", "src"]), "after")
    assert {(r["k"], r["v"]) for r in after.collect()} == {(1, "a"), (2, "B"), (3, "c"), (4, "d")}
    table, refused = sync.undo(after, base, plan, ["k"])
    assert {tuple(r) for r in table.select("k", "v").collect()} == {(1, "a"), (2, "b"), (3, "c")} and refused.count() == 0
    touched = after.withColumn("output_sha256", F.when(F.col("k") == 2, "else").otherwise(F.col("output_sha256")))
    table, refused = sync.undo(touched, base, plan, ["k"])
    assert [r["k"] for r in refused.collect()] == [2] and table.where("k = 2").first()["v"] == "B"
    tampered = base.withColumn("v", F.when(F.col("k") == 1, "z").otherwise(F.col("v")))
    assert sync.guarded_plan(tampered, incoming, ["k"], ["v", "src"]).where("k = 1").first()["action"] == "tampered"
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (3, "c")], "k int, name string")
    assert {r["conflict"] for r in sync.owner_conflicts(rows, "k", ["name"]).collect()} == {"natural_value_of_two_keys", "key_of_two_natural_values"}
    changes = sync.set_changes(spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int"))
    assert {tuple(r) for r in changes.collect()} == {(3, "insert"), (1, "delete")}


def test_fingerprint_tells_null_and_separators_apart(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a|b", "c"), (4, "a", "b|c")], "k int, a string, b string")
    assert rows.select(quality.row_digest(["a", "b"])).distinct().count() == 4


def test_publish_refuses_a_second_writer(spark, tmp_path):
    root, gates = f"file://{tmp_path}/dw", lambda read: quality.not_empty("facts", read("facts"))
    first = publish.publish(spark, root, {"facts": spark.range(2)}, gates, expected=None)
    publish.publish(spark, root, {"facts": spark.range(3)}, gates, expected=first)
    with pytest.raises(publish.PublishRejected):
        publish.publish(spark, root, {"facts": spark.range(4)}, gates, expected=first)
    publish._point_to(spark, root, first, "publish")
    (tmp_path / "dw" / "manifest" / "extra.txt").write_text(json.dumps({"number": 0, "snapshot": "x", "action": "publish"}) + "\n")
    with pytest.raises(publish.PublishRejected):
        publish.current(spark, root)


def arrive(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={number}")
    return spark.readStream.schema(schema + ", part int").option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_stream_tables_with_late_rows(spark, tmp_path):
    schema = "job string, at int, run string"
    arrive(spark, f"file://{tmp_path}/in", 1, [("a", 2, "r2"), ("b", 5, "r5")], schema)
    stream = arrive(spark, f"file://{tmp_path}/in", 2, [("a", 1, "r1"), ("b", 5, "r6"), ("a", 2, "r2")], schema).drop("part")
    newest = jobs.keep_table(stream, schema, jobs.merge_latest("job", "at", "run"))
    assert {tuple(r) for r in newest.collect()} == {("a", 2, "r2"), ("b", 5, "r6")}
    history = jobs.keep_table(stream, schema, jobs.merge_history("job", "run"))
    assert history.count() == 4
    seen = jobs.keep_table(stream, "job string, first_seen int, last_seen int, n long", jobs.merge_seen("job", "at"))
    assert {tuple(r) for r in seen.collect()} == {("a", 1, 2, 3), ("b", 5, 5, 2)}
    fresh = jobs.keep_table(stream, schema, jobs.unknown_only(spark.createDataFrame([("a",)], "job string"), "job"))
    assert [r["job"] for r in fresh.collect()] == ["b"]
    again = jobs.merge_history("job", "run")(history, spark.createDataFrame([("a", 1, "r1")], schema))
    assert again.count() == 4


def test_watermark_makes_days_final(spark, tmp_path):
    schema = "at timestamp, kind string"
    day = lambda d, h=0: dt.datetime(2026, 1, d, h)
    arrive(spark, f"file://{tmp_path}/in", 1, [(day(1), "x"), (day(1, 5), "x")], schema)
    arrive(spark, f"file://{tmp_path}/in", 2, [(day(9), "x")], schema)
    arrive(spark, f"file://{tmp_path}/in", 3, [(day(9, 1), "x")], schema)  # rows are held against the watermark of the batch before
    stream = arrive(spark, f"file://{tmp_path}/in", 4, [(day(1, 7), "x"), (day(9, 2), "x")], schema).drop("part")
    final = jobs.run_available(jobs.daily_counts(stream, "at", "1 day", "kind"), "append").collect()
    assert [(r["day"], r["n"]) for r in final] == [(dt.date(2026, 1, 1), 2)]  # the row that came too late is not counted, the open day not given out
    assert jobs.run_available(jobs.first_claims(stream, "kind", ("at", "30 days")), "append").count() == 1


def test_views(spark):
    observed = spark.createDataFrame([(1, "a", 1, "r1", "old"), (2, "a", 2, "r1", "t2"), (3, "b", 1, "r1", "t3"), (4, "b", 1, "r2", "t4")], "observation_key int, job_id string, observed_at int, crawl_run_id string, title string")
    bridge = spark.createDataFrame([(1, "Java", "l"), (2, "Go", "l"), (4, "Go", "l")], "observation_key int, name string, category string")
    assert {r["observation_key"] for r in views.fact_job_latest(observed).collect()} == {2, 4}
    assert [tuple(r) for r in views.demand_latest(observed, bridge).collect()] == [("Go", "l", 2, 2, 100.0)]
    assert views.bridge_latest(observed, bridge).count() == 2
    issues = spark.createDataFrame([(1, "old"), (4, "open")], "observation_key int, reason string")
    assert [r["reason"] for r in views.review_queue(observed, issues).collect()] == ["open"]
    assert views.latest_facts(observed, bridge, ["observation_key"]).count() == 2


def test_commands(spark, tmp_path, capsys):
    raw, norm, dw = (f"file://{tmp_path}/{x}" for x in ("raw", "norm", "dw"))
    spark.createDataFrame([topdev(), itviec(), topdev("Senior Accountant")[:0] + ("topdev:9", *topdev("Senior Accountant")[1:])], COLUMNS).write.parquet(raw)
    run = lambda *args: commands.main(list(args), spark)
    assert run("normalize", "--input", raw, "--output", norm, "--apply") == commands.SOME_REJECTED
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["outcomes"] == {"normalized": 2, "no_matching_role_keyword": 1}
    assert run("warehouse", "--input", norm, "--output", dw) == commands.DONE and publish.current(spark, dw) is None
    assert run("warehouse", "--input", norm, "--output", dw, "--apply") == commands.DONE
    first = publish.current(spark, dw)
    assert run("warehouse", "--input", norm, "--output", dw, "--apply", "--all-observations") == commands.DONE
    assert set(json.loads(capsys.readouterr().out.splitlines()[-1])["added"].values()) == {0}
    assert run("rollback", "--output", dw, "--expected", "wrong") == commands.STORAGE
    assert run("rollback", "--output", dw, "--expected", publish.current(spark, dw)) == commands.DONE and publish.current(spark, dw) == first
    assert run("analytics", "--input", norm, "--output", f"{dw}-a", "--apply") == commands.DONE and publish.current(spark, f"{dw}-a")


# -- guarded tables ------------------------------------------------------------------------------------------------
def held(spark, root):
    return {tuple(r) for r in guarded.read(spark, root).select("k", "v").collect()}


def test_guarded_table_from_disk(spark, tmp_path):
    """Apply, tamper, refuse, roll back, apply again: each step reads what the one before has stored."""
    root, keys = f"file://{tmp_path}/t", ["k"]
    frame = lambda *rows: spark.createDataFrame(list(rows), "k int, v string, at timestamp")
    at = dt.datetime(2026, 1, 1)
    one = guarded.apply(spark, root, frame((1, "a", at), (2, None, at), (None, "n", None)), keys)
    assert one["insert"] == 3 and held(spark, root) == {(1, "a"), (2, None), (None, "n")}
    stamps = {r["k"]: r["loaded_at"] for r in guarded.read(spark, root).collect()}
    two = guarded.apply(spark, root, frame((1, "a", at), (2, "", at), (3, "c", at)), keys, scope=F.lit(True))
    assert (two["unchanged"], two["update"], two["insert"], two["delete"]) == (1, 1, 1, 1)
    assert {r["k"]: r["loaded_at"] for r in guarded.read(spark, root).collect()}[1] == stamps[1]
    receipts = {r["k"]: r for r in guarded.read(spark, root, "receipts").collect()}
    assert {k: r["action"] for k, r in receipts.items()} == {2: "update", 3: "insert", None: "delete"} and receipts[None]["before"]["v"] == "n" and receipts[None]["after_sha256"] is None
    assert guarded.apply(spark, root, frame((1, "a", at), (2, "", at), (3, "c", at)), keys)["snapshot"] == two["snapshot"]  # nothing to do, nothing written
    assert guarded.apply(spark, root, frame((1, "z", at)), keys, dry_run=True)["update"] == 1 and publish.current(spark, root) == two["snapshot"]
    with pytest.raises(guarded.RollbackRefused):
        guarded.rollback(spark, root, one["snapshot"], keys)
    back = guarded.rollback(spark, root, two["snapshot"], keys)
    assert back["undone"] == 3 and held(spark, root) == {(1, "a"), (2, None), (None, "n")}
    forth = guarded.rollback(spark, root, back["snapshot"], keys)  # a rollback has receipts of its own
    assert held(spark, root) == {(1, "a"), (2, ""), (3, "c")}
    folder = tmp_path / "t" / f"snapshot={forth['snapshot']}" / "rows"
    rows = [r.asDict() for r in guarded.read(spark, root).collect()]
    schema = guarded.read(spark, root).schema
    spark.createDataFrame([tuple({**r, "v": "x" if r["k"] == 1 else r["v"]}.values()) for r in rows], schema).write.mode("overwrite").parquet(f"file://{folder}")
    with pytest.raises(guarded.Tampered):
        guarded.apply(spark, root, frame((5, "e", at)), keys)
    spark.createDataFrame([tuple({**r, "v": "x" if r["k"] == 3 else r["v"]}.values()) for r in rows], schema).write.mode("overwrite").parquet(f"file://{folder}")
    with pytest.raises(guarded.RollbackRefused):  # the row that the change put in is no longer as it was left
        guarded.rollback(spark, root, forth["snapshot"], keys)


def test_guarded_table_refuses_rows_that_share_a_key(spark, tmp_path):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(publish.PublishRejected):
        guarded.apply(spark, f"file://{tmp_path}/t", twice, ["k"])
    assert guarded.read(spark, f"file://{tmp_path}/t") is None
    nothing = guarded.apply(spark, f"file://{tmp_path}/t", twice.limit(0), ["k"])
    assert nothing == {"snapshot": None}


def test_outputs_of_observations(spark, tmp_path):
    """An output holds all of an observation; its bridges are what atomize_records gives."""
    rows = [record(skills=[("Java/React", "other"), ("English", "other")], foreign_languages=[("English", "TOEIC 650"), ("English", "TOEIC 650")]), record("topdev:2", skills=[("InternalFoo/Bar", "tool")]), record("topdev:3", job_roles=[])]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = stored(atomize.outputs(frame), "t")
    values, issues = atomize.atomize_records(frame)
    same = lambda a, b: {tuple(r) for r in a.select(*b.columns).collect()} == {tuple(r) for r in b.collect()} and a.count() == b.count()
    assert found.count() == 2 and same(atomize.values_of(found), values) and same(atomize.issues_of(found), issues)
    root, keys = f"file://{tmp_path}/a", ["observation_key"]
    assert guarded.apply(spark, root, found, keys)["insert"] == 2
    again = spark.createDataFrame(rows[:2], SCHEMA).repartition(3)
    assert guarded.apply(spark, root, atomize.outputs(again), keys)["unchanged"] == 2
    changed = atomize.outputs(frame, {**dictionaries.CATALOGUE, "business_domain": []})  # another catalogue is another model
    assert guarded.apply(spark, root, changed, keys)["update"] == 2


def test_normalize_twice_and_a_record_that_is_rejected_later(spark, tmp_path, capsys, monkeypatch):
    raw, out = (f"file://{tmp_path}/{x}" for x in ("raw", "out"))
    spark.createDataFrame([itviec(), topdev()], COLUMNS).write.parquet(raw)
    records = stored(commands.normalize.normalized(spark.read.parquet(raw)), "t")
    monkeypatch.setattr(commands.normalize, "normalized", lambda postings: records)  # worked out once; the command is what is tested
    run = lambda *args: commands.main(["normalize", "--input", raw, "--output", out, *args], spark)
    run("--apply")
    first = publish.current(spark, out)
    stamps = {r["job_id"]: r["normalized_at"] for r in guarded.read(spark, out).collect()}
    assert len(stamps) >= 1
    run("--apply")
    assert publish.current(spark, out) == first and {r["job_id"]: r["normalized_at"] for r in guarded.read(spark, out).collect()} == stamps
    changes = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["changes"]
    assert set(changes) == {"unchanged", "snapshot"}
    rejected = records.withColumn("reject_reason", F.lit("no_matching_role_keyword"))
    monkeypatch.setattr(commands.normalize, "normalized", lambda postings: rejected)
    assert run("--apply") == commands.SOME_REJECTED and guarded.read(spark, out).count() == 0
    assert commands.main(["rollback", "--table", "normalize", "--output", out, "--expected", publish.current(spark, out)], spark) == commands.DONE
    assert {r["job_id"]: r["normalized_at"] for r in guarded.read(spark, out).collect()} == stamps


def test_retraction_of_facts(spark):
    """A skill and a city that a record no longer names lose their facts; other observations keep theirs; a rerun changes nothing."""
    many = [(n, "x") for n in ("Python", "SQL", "Git", "Django", "Java", "React", "Docker", "AWS", "Azure")]
    first = [record(skills=many, foreign_languages=[("English", None), ("English", "TOEIC 650")], cities=["HCMC", "Ha Noi"]), record("topdev:2", skills=[("SQL", "x")], cities=["HCMC"])]
    one, n = loaded(spark, star_load.bootstrap(spark), *first)
    assert n["fact_job_necessary_skill"] == 12 and n["fact_job_role_city"] == 3
    second = record(skills=[s for s in many if s[0] != "SQL"], foreign_languages=[("English", "TOEIC 650")], cities=["HCMC"])

    def again(before, *rows, retract):
        frame = spark.createDataFrame(list(rows), SCHEMA)
        values = stored(atomize.atomize_records(frame)[0], "t")
        after = star_load.load(before, stored(atomize.observations(frame, values), "t"), values, retract=retract)
        return {name: stored(df, "t") for name, df in after.items()}

    kept = again(one, second, retract=False)
    assert kept["fact_job_necessary_skill"].count() == 12 and kept["fact_job_role_city"].count() == 3
    two = again(one, second, retract=True)
    changes = {(r["table"], r["action"]): r["n"] for r in star_load.fact_changes(one, two).collect()}
    assert changes == {("fact_job_necessary_skill", "delete"): 3, ("fact_job_necessary_skill", "insert"): 1, ("fact_job_role_city", "delete"): 1}
    sql = two["dim_skill"].where("normalized_name = 'sql'").select("skill_key")
    assert [r["job_key"] for r in two["fact_job_necessary_skill"].join(sql, "skill_key").collect()] == [r["job_key"] for r in two["dim_job"].where("job_id = 'topdev:2'").collect()]
    assert quality.all_pass(star_load.gates(two.__getitem__))
    assert star_load.fact_changes(two, again(two, second, retract=True)).count() == 0


def test_rows_of_an_observation_are_dealt_out_once(spark):
    frame = spark.createDataFrame([record(skills=[("SQL", "x"), ("Git", "x")], foreign_languages=[("English", None)], cities=["HCMC", "Ha Noi"])], SCHEMA)
    values = stored(atomize.atomize_records(frame)[0], "t")
    observed = stored(atomize.observations(frame, values), "t")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = star_load.new_facts(observed, values)
        plans = {n: facts[n]._jdf.queryExecution().executedPlan().toString() for n in star_load.CARRIED}
        rows = {n: facts[n].count() for n in star_load.CARRIED}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {n: p.count("Exchange hashpartitioning(") for n, p in plans.items()} == {"fact_job_necessary_skill": 2, "fact_job_role_city": 3}
    assert rows == {"fact_job_necessary_skill": 3, "fact_job_role_city": 2}


def test_retraction_keeps_any_observation_id(spark):
    ids = ["legacy", "", None, "ab" * 32, "AB" * 32, "AB" * 31, "text:x"]
    ddl, grain = star_load.TABLES["fact_job_role_city"]
    facts = spark.createDataFrame([(x, n, 1, 1, 1, 1, 1, 1) for n, x in enumerate(ids)], ddl)
    lineage = spark.createDataFrame([("New", 1, 1), ("CD" * 32, 3, 1), ("Unseen", 99, 1)], "observation_id string, job_key long, crawl_run_key long")
    wanted = facts.where("job_key IN (1, 3)").withColumn("observation_id", F.lit("not carried"))
    after = star_load.exact(facts, wanted, lineage, grain, [])
    assert {r["job_key"]: r["observation_id"] for r in after.collect()} == dict(enumerate(ids)) | {1: "New", 3: "CD" * 32}
