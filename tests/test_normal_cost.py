"""What normalising costs: values are worked out once, whatever uses them; the shorter ways give what the plain ones do."""

from __future__ import annotations

import itertools
import re

from gleaner.functions import dictionaries, rules
from gleaner.functions import payload as pl
from gleaner.functions import text as tx
from gleaner.operators import gate
from gleaner.plans import changes, postings
from pyspark.sql import functions as F


def plan_of(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def test_a_field_is_looked_at_once(spark):
    df = spark.createDataFrame([('{"a": "x"}',)], "j string").select(F.try_parse_json("j").alias("v"))
    assert plan_of(df.select(pl.scalar(pl.at(F.col("v"), "a")).alias("x"))).count("schema_of_variant") == 1
    assert plan_of(df.select(pl.first_true(pl.at(F.col("v"), "a"), pl.at(F.col("v"), "b")).alias("x"))).count("schema_of_variant") == 2


def test_postings_seen_before_share_the_plan_of_the_others(spark, sf_dir, monkeypatch):
    """Either side of the union would be normalised by a projection of its own."""
    seen = []
    monkeypatch.setattr(changes.normalize, "normalized", lambda rows: seen.append(rows) or rows.limit(0).limit("stop"))
    try:
        changes.posting_to_demand(spark, sf_dir)
    except Exception:  # noqa: BLE001 - only the rows that were handed over count
        pass
    top = seen[0]._jdf.queryExecution().optimizedPlan().nodeName()
    assert top.startswith("Repartition") and seen[0].count() > postings.raw_postings(spark, sf_dir).count()


def test_short_ways_give_what_the_plain_ones_do(spark):
    values = [None, "", "  ", "Kỹ sư  Dữ liệu", "STRASSE Straße", "plain ASCII\ttext", "ＡＢＣ １２", "İstanbul", "été"]
    source, target = tx._fold_table()
    plain = F.regexp_replace(F.translate(F.replace(F.lower(F.coalesce("x", F.lit(""))), F.lit("ß"), F.lit("ss")), source, target), r"\p{M}+", "")
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert all(a == b for a, b in df.select(tx.strip_marks("x"), plain).collect())
    cleaned = df.agg(F.collect_list("x").alias("v")).select(tx.clean_items(F.col("v")), F.filter(F.transform("v", tx.clean_text), lambda x: x.isNotNull())).first()
    assert cleaned[0] == cleaned[1]


def test_every_wording_of_a_work_mode_holds_a_word_of_it():
    for name, pattern in rules.WORK_MODES.items():
        for wording in re.split(r"\|(?![^(]*\))", pattern):
            plain = wording.replace("^", "").replace("$", "").replace(r"\b", "")
            parts = [[""] if not p else p.split("|") for p in (x.strip("()?:") for x in re.split(r"(\(\?:[^)]*\)\??)", plain))]
            for said in map("".join, itertools.product(*parts)):
                assert any(w in said for w in rules.WORK_MODE_WORDS[name]), (name, wording, said)


def test_places_by_a_tree_are_those_of_the_longest_alias(spark):
    longest = sorted(dictionaries.PLACES, key=lambda a: (-len(a), a))
    plain = re.compile(r"(?<![a-z0-9])(" + "|".join(map(re.escape, longest)) + r")(?![a-z0-9])")
    tree = re.compile(r"(?<![a-z0-9])(" + tx.tree_pattern(sorted(dictionaries.PLACES)) + r")(?![a-z0-9])")
    texts = [f"{a} {b}" for a in longest for b in longest[:12]] + [f"{a}{b}" for a in longest for b in ("x", " city", "1")]
    assert all(plain.findall(t) == tree.findall(t) for t in texts)


def test_role_table_lists_the_keywords_a_phrase_begins_with(spark):
    roles = {"A": ("data engineer", "data"), "B": ("data", "engineer")}
    found = spark.range(1).select(gate.role_matches(F.lit("Senior Data Engineer"), roles)).first()[0]
    assert [(m["role"], m["keyword"]) for m in found] == [("A", "data engineer"), ("B", "engineer")]
