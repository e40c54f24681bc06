"""Role queries over whole texts, on a fixture."""

from __future__ import annotations

import random

import pytest
from gleaner.operators import gate
from gleaner.plans import registry
from pyspark.sql import functions as F

LATE = "plain words without a role " * 20
TEXTS = {
    1: "one of the many " + LATE,
    2: LATE + "here is one of the many",
    3: LATE + "einer von vielen und die anderen",
    4: LATE + "profit undo often",
    5: LATE + "und so one of many",
    6: "",
    7: None,
}


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("roles"))
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return path


def longest(text, *keywords):
    return next((k for k in keywords if f" {k} " in f" {text or ''} "), None)


def test_role_gate_equals_brute_force(spark, fixture_dir):
    found = {}
    for r in registry.QUERIES["role_gate"](spark, fixture_dir).collect():
        found.setdefault(r["doc_id"], {})[r["role"]] = r["keyword"]
    want = {i: {"Role of": longest(x, "of the", "of"), "Role und": longest(x, "und die", "und")} for i, x in TEXTS.items()}
    assert found == {i: {r: k for r, k in roles.items() if k} for i, roles in want.items() if any(roles.values())}


def test_phrases_of_one_tree_equal_single_searches(spark):
    """Phrases that overlap, begin alike, hold each other or repeat, at both ends of a text."""
    rng = random.Random(8)
    names = ["a", "a b", "a b c", "b", "b c a", "c a b", "ab", "ab c", "d"]
    texts = [" ".join(rng.choice(["a", "b", "c", "ab", "abc", "d", "e"]) for _ in range(rng.randrange(12))) for _ in range(300)] + ["", None, "a " * 5000]
    roles = {n: (n,) for n in names}
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in frame.select("i", gate.role_matches(F.col("text"), roles)["role"].alias("found")).collect():
        padded = f" {(texts[r['i']] or '').strip()} "
        assert set(r["found"]) == {n for n in names if f" {n} " in padded}
    with pytest.raises(ValueError):
        gate.phrases_in(F.lit(""), ["C++"])


def test_gate_reasons_sees_roles_late_in_a_text(spark, fixture_dir):
    found = {}
    for r in registry.QUERIES["gate_reasons"](spark, fixture_dir).collect():
        found[r["reason"]] = found.get(r["reason"], 0) + r["n"]
    matched = sum(longest(x, "of the", "of", "und die", "und") is not None for x in TEXTS.values())
    assert found["missing_role_text"] == 2 and sum(found.values()) == len(TEXTS)
    assert found.get("matched_role_keyword", 0) == matched
