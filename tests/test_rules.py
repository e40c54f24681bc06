from __future__ import annotations

import pytest
from gleaner.functions import dictionaries, rules
from gleaner.functions import text as tx
from gleaner.operators import atomize, gate
from gleaner.sources import html
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,levels",
    [
        ("0.5-2 years of work experience.", ["Fresher", "Junior"]),
        ("1-2 years of work experience.", ["Junior"]),
        ("3-4 years of work experience.", ["Mid-level"]),
        ("4-6 years of work experience.", ["Mid-level", "Senior"]),
        ("5-7 years of work experience.", ["Senior"]),
        ("1-5 years of work experience.", []),
        ("Under 3 years of work experience.", ["Fresher", "Junior"]),
    ],
)
def test_experience_bands(spark, text, levels):
    found = rules.experience(F.lit(text))
    assert one(spark, rules.experience_levels(found["low"], found["high"], found["relation"])) == levels


@pytest.mark.parametrize(
    "text,low",
    [
        ("At least 4 years of work experience. 6 years Java.", 4),
        ("3 years Java", None),
        ("Tối thiểu 4 năm kinh nghiệm làm việc", 4),
        ("6 tháng kinh nghiệm", 0.5),
        ("At least 2 years of work experience; at least 5 years of work experience", 5),
        (None, None),
    ],
)
def test_experience(spark, text, low):
    found = one(spark, rules.experience(F.lit(text).cast("string")))
    assert (found and found["low"]) == low


def test_seniority_precedence(spark):
    found = one(spark, rules.seniority(F.array(F.lit("Junior")), F.lit("Senior Engineer"), F.array(F.lit("Senior"))))
    assert found["levels"] == ["Junior"] and found["source"] == "source" and len(found["conflicts"]) == 2
    assert one(spark, rules.declared_level(F.lit("Chuyên viên cao cấp"))) == "Senior"
    assert one(spark, rules.declared_levels(F.array(F.lit("Tất cả cấp bậc"), F.lit("Senior")))) == ["All levels"]


def test_salary(spark):
    found = one(spark, rules.salary(F.lit("20 - 30 triệu VND/tháng, gross")))
    assert (found["low"], found["high"], found["currency"], found["period"], found["basis"], found["status"]) == (2e7, 3e7, "VND", "month", "gross", "disclosed")
    assert one(spark, rules.salary(F.lit("Negotiable")))["status"] == "negotiable"
    assert one(spark, rules.salary(F.lit(None).cast("string")))["status"] == "not_disclosed"


def test_work_mode(spark):
    assert one(spark, rules.work_mode(F.lit("fully remote"), F.lit(""))) == "remote"
    assert one(spark, rules.work_mode(F.lit(None).cast("string"), F.lit("hybrid cloud for remote users"))) is None


def test_places(spark):
    assert one(spark, rules.places_in(F.lit("Bà Rịa - Vũng Tàu"), dictionaries.PLACES)) == ["Bà Rịa - Vũng Tàu"]
    assert one(spark, rules.places_in(F.lit("HCMC, Hà Nội và Sài Gòn"), dictionaries.PLACES)) == ["Hồ Chí Minh", "Hà Nội"]


def test_languages(spark):
    assert [tuple(x) for x in one(spark, rules.foreign_languages(F.lit("English TOEIC 650 required.")))] == [("English", "TOEIC 650", ["English TOEIC 650 required."])]
    assert [tuple(x)[:2] for x in one(spark, rules.foreign_languages(F.lit("nothing")))] == [("unknown", None)]


@pytest.mark.parametrize("text,want", [("Kỹ sư phần mềm với kinh nghiệm và kỹ năng", "vi"), ("소프트웨어 엔지니어 모집", "other"), ("Data engineer with the skills", "en"), ("", "unknown"), ("123", "unknown")])
def test_posting_language(spark, text, want):
    assert one(spark, rules.posting_language(F.lit(text))) == want


def test_roles(spark):
    found = one(spark, gate.role_matches(F.lit("[Vũng Tàu] AI Engineer / Full Stack Engineer"), dictionaries.ROLES))
    assert {m["role"] for m in found} == {"AI Engineer", "Full-stack Developer"}
    assert one(spark, gate.role_matches(F.lit("Senior Accountant"), dictionaries.ROLES)) == []


def test_split_value(spark):
    known = atomize.lookup({"java": "Java", "react": "React", "c/c++": "C/C++", "ci/cd": "CI/CD"})
    split = lambda v: one(spark, atomize.split_value(F.lit(v), known))
    assert split("Java/React")["atoms"] == ["Java", "React"]
    assert split("CI/CD")["atoms"] == ["CI/CD"]
    assert split("InternalFoo/Bar")["issue"] == "unresolved_composite" and split("InternalFoo/Bar")["atoms"] == []
    assert split("MysteryTech")["atoms"] == ["MysteryTech"]


def test_skills(spark):
    assert one(spark, atomize.canonical_skills(F.array(*map(F.lit, ("ReactJS", "NodeJS", "Postgres", "C/C++", "react"))), dictionaries.SKILL_ALIASES)) == ["React", "Node.js", "PostgreSQL", "C", "C++", "react"]


def test_identity(spark):
    import hashlib

    want = hashlib.sha256("topdev:1|run-1".encode("utf-16-le")).hexdigest().upper()
    assert one(spark, tx.observation_id(F.lit("topdev:1"), F.lit("run-1"))) == want
    assert one(spark, tx.canonical_url(F.lit("HTTPS://u@Example.com:8080/jobs/12/?ref=x#top"))) == "https://example.com/jobs/12"
    assert one(spark, tx.split_values(F.lit("Java, java | Go;\nRust"))) == ["Java", "Go", "Rust"]


def test_html():
    page = '<html><head><title>x</title><script type="application/ld+json">{"@graph": [{"a": 1}, {"b": 2}]}</script></head><body><p>One</p><ol><li>A</li><li>B</li></ol><script>no</script></body></html>'
    assert html.plain_text(page) == "One\n1. A\n2. B"
    assert html.embedded_data(page) == ['{"a": 1}', '{"b": 2}']
    assert html.plain_text(None) is None and html.embedded_data('<script type="application/ld+json">{broken</script>') == []


def test_id_after_source(spark):
    rows = spark.createDataFrame([("topdev:12",), ("a:b:c",), ("bare",), (None,)], "v string")
    assert [r[0] for r in rows.select(tx.id_after_source("v")).collect()] == ["12", "b:c", "bare", None]


def test_short_evidence(spark):
    assert one(spark, tx.short_evidence(F.lit("x" * 300))) == "x" * 239 + "…" and one(spark, tx.short_evidence(F.lit(" a  b "))) == "a b"


def test_work_mode_conflicts(spark):
    found = rules.work_mode_conflicts(F.lit("Hybrid"), F.lit("fully remote position"))
    assert one(spark, found) == ["description: remote"]


@pytest.mark.parametrize(
    "text,level",
    [
        ("Able to communicate in English", "Able to communicate in English"), ("giao tiếp tốt bằng tiếng Anh", "giao tiếp tốt bằng tiếng Anh"), ("B2 English", "B2 English"),
        ("English fluency; IELTS 6.5", "IELTS 6.5"), ("Business Japanese", "Business Japanese"), ("HSK 5", "HSK 5"), ("Can communicate in Mandarin", "Can communicate in Mandarin"),
    ],
)
def test_language_levels(spark, text, level):
    assert one(spark, rules.foreign_languages(F.lit(text)))[0]["level_text"] == level
