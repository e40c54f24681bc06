"""Raw postings made from parts, and what becomes of them. The SQL side works from tables of what each piece of a posting stands for."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contract, normalize
from ..storage import spread
from .base import query, t

#: Pieces of a posting, each with what it stands for.
TITLES = (
    ("Senior Data Engineer", "Data Engineer", "Senior"),
    ("Back-end Developer", "Back-end Developer", None),
    ("Junior QA Engineer", "QA Engineer", "Junior"),
    ("iOS Developer", "iOS Developer", None),
    ("DevOps Engineer", "DevOps Engineer", None),
    ("Senior Accountant", None, "Senior"),
    ("Product Owner", "Product Owner", None),
    ("Principal Engineer", "Principal Engineer", "Principal"),
)
CITIES = (("Ha Noi", "Hà Nội"), ("HCMC", "Hồ Chí Minh"), ("Đà Nẵng", "Đà Nẵng"), ("Bà Rịa - Vũng Tàu", "Bà Rịa - Vũng Tàu"), ("nowhere", None))
MODES = (("Fully remote", "remote"), ("Hybrid", "hybrid"), ("Fulltime", None))
SKILLS = (
    ("ReactJS,Kafka", (("React", "framework_library"), ("Kafka", "other"))),
    ("C/C++;English", (("C", "programming_language"), ("C++", "programming_language"))),
    ("golang|Docker|docker", (("Go", "programming_language"), ("Docker", "devops"))),
    ("MysteryTech", (("MysteryTech", "other"),)),
)


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def raw_postings(spark, d):
    """A posting of either source for each part."""
    p, s = F.col("p_partkey"), F.col("p_size")
    topdev = p % 2 == 0
    english = F.when(p % 7 < 3, F.concat(F.lit(" English TOEIC "), (500 + s).cast("string"), F.lit(" required."))).otherwise("")
    required = F.concat(F.lit("<ul><li>At least "), (s % 9).cast("string"), F.lit(" years of professional experience.</li></ul>"), english)
    title, city, mode, skill = _pick([x[0] for x in TITLES], p % 8), _pick([x[0] for x in CITIES], s % 5), _pick([x[0] for x in MODES], s % 3), _pick([x[0] for x in SKILLS], s % 4)
    told = F.concat((10 + s).cast("string"), F.lit(" - "), (20 + s).cast("string"), F.lit(" triệu VND/tháng"))
    salary = F.when(p % 3 == 0, F.to_json(F.struct(told.alias("text")))).when(
        p % 3 == 1, F.to_json(F.struct((1000 * s).alias("min_filter"), (500 * s).alias("max_filter"), F.lit("usd").alias("currency"), F.lit("MONTH").alias("unit")))
    ).otherwise(F.to_json(F.struct(F.lit("Negotiable").alias("text"))))
    own = lambda name, value: F.when(topdev, value[0]).otherwise(value[1]).alias(name)
    none = F.lit(None).cast("string")
    body = F.struct(
        title.alias("title"),
        own("company_name", (none, F.col("p_brand"))),
        own("company", (F.col("p_brand"), none)),
        own("description", (F.col("p_name"), none)),
        own("job_description", (none, F.concat(F.lit("<p>"), "p_name", F.lit("</p>")))),
        own("requirements", (required, none)),
        own("your_skills_and_experience", (none, required)),
        own("skills_str", (skill, none)),
        own("skills", (none, skill)),
        own("location_text", (city, none)),
        own("city_on_listing", (none, city)),
        own("job_types_str", (mode, none)),
        own("working_model", (none, mode)),
    )
    payload = F.concat(F.regexp_replace(F.to_json(body), r"\}$", ""), F.lit(',"salary":'), salary, F.lit("}"))
    source = F.when(topdev, "topdev").otherwise("itviec")
    return spread(t(spark, d, "part")).select(
        F.concat(source, F.lit(":"), p.cast("string")).alias("job_id"),
        F.concat(F.lit("run_"), (s % 3).cast("string")).alias("crawl_run_id"),
        source.alias("source"),
        p.cast("string").alias("source_job_id"),
        F.concat(F.lit("HTTPS://"), source, F.lit(".vn/jobs/"), p.cast("string"), F.lit("/?ref=list#x")).alias("job_url"),
        F.concat(F.lit("2026-11-0"), (1 + p % 9).cast("string"), F.lit("T10:00:00+07:00")).alias("observed_at"),
        payload.alias("raw_payload"),
    )


def _values(rows) -> str:
    cell = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows) + ")"


EXPECTED_SQL = f"""titles AS (SELECT * FROM {_values([(k, *x[1:]) for k, x in enumerate(TITLES)])} AS v(k, role, level)),
  cities AS (SELECT * FROM {_values([(k, x[1]) for k, x in enumerate(CITIES)])} AS v(k, city)), modes AS (SELECT * FROM {_values([(k, x[1]) for k, x in enumerate(MODES)])} AS v(k, mode)),
  expected AS (SELECT p_partkey AS p, p_size AS s, CASE WHEN p_partkey % 2 = 0 THEN 'topdev' ELSE 'itviec' END AS source, role, city, mode,
    coalesce(level, CASE WHEN p_size % 9 < 1 THEN 'Fresher' WHEN p_size % 9 < 3 THEN 'Junior' WHEN p_size % 9 < 5 THEN 'Mid-level' ELSE 'Senior' END) AS level
    FROM part JOIN titles t ON t.k = p_partkey % 8 JOIN cities c ON c.k = p_size % 5 JOIN modes m ON m.k = p_size % 3)"""


@query(f"""WITH {EXPECTED_SQL}
  SELECT source || ':' || p AS job_id, 'https://' || source || '.vn/jobs/' || p AS job_url, coalesce(role, '') AS roles, level AS levels, coalesce(city, '') AS cities, mode AS work_mode,
    CAST(s % 9 AS DOUBLE) AS years, CAST(CASE p % 3 WHEN 0 THEN (10 + s) * 1e6 WHEN 1 THEN 500 * s END AS DOUBLE) AS salary_min, CAST(CASE p % 3 WHEN 0 THEN (20 + s) * 1e6 WHEN 1 THEN 1000 * s END AS DOUBLE) AS salary_max,
    CASE p % 3 WHEN 0 THEN 'VND' WHEN 1 THEN 'USD' END AS currency, CASE WHEN p % 3 < 2 THEN 'month' END AS period, CASE WHEN p % 3 = 2 THEN 'negotiable' ELSE 'disclosed' END AS status,
    CASE WHEN p % 7 < 3 THEN 'English: TOEIC ' || (500 + s) WHEN s % 4 = 1 THEN 'English' ELSE 'unknown' END AS languages,
    CASE WHEN role IS NULL THEN 'no_matching_role_keyword' END AS reject_reason FROM expected""")
def normalized_record(spark, d):
    r = normalize.normalized(raw_postings(spark, d))
    spoken = F.transform("foreign_languages", lambda x: F.concat_ws(": ", x["language"], x["level_text"]))
    return r.select(
        "job_id", "job_url", F.array_join("job_roles", "|").alias("roles"), F.array_join("seniority_levels", "|").alias("levels"), F.array_join("cities", "|").alias("cities"), "work_mode",
        F.col("experience_min_years").cast("double").alias("years"), F.col("salary_min").cast("double").alias("salary_min"), F.col("salary_max").cast("double").alias("salary_max"),
        F.col("salary_currency").alias("currency"), F.col("salary_period").alias("period"), F.col("salary_status").alias("status"), F.array_join(spoken, "|").alias("languages"), "reject_reason",
    )


@query(f"WITH {EXPECTED_SQL} SELECT CASE WHEN role IS NULL THEN 'no_matching_role_keyword' ELSE 'normalized' END AS outcome, count(*) AS n FROM expected GROUP BY 1")
def contract_rejects(spark, d):
    return normalize.outcome_counts(normalize.normalized(raw_postings(spark, d)))


@query(f"""WITH {EXPECTED_SQL}, skills AS (SELECT * FROM {_values([(k, *pair) for k, x in enumerate(SKILLS) for pair in x[1]])} AS v(k, name, category))
  SELECT name, category, count(*) AS n FROM expected JOIN skills ON k = s % 4 WHERE role IS NOT NULL GROUP BY 1, 2""")
def normalized_skills(spark, d):
    stored = normalize.persisted(normalize.normalized(raw_postings(spark, d)))
    return stored.select(F.explode("skills").alias("x")).groupBy("x.name", "x.category").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH k AS (SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderdate FROM orders), r AS (SELECT CASE WHEN o_totalprice < 1500 THEN 'price' END AS a, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status' END AS b FROM k)
  SELECT 'price' AS rule, count(a) AS violations FROM r UNION ALL SELECT 'status', count(b) FROM r UNION ALL SELECT 'date', 0""")
def table_checks(spark, d):
    rules = {"price": lambda: F.col("o_totalprice") >= 1500, "status": lambda: F.col("o_orderstatus").isin("F", "O"), "date": lambda: F.col("o_orderdate").isNotNull()}
    return contract.violation_counts(t(spark, d, "orders"), rules)
