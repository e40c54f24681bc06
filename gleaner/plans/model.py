"""Atoms and the direct star load, over normalised records made from orders: a customer is a job, an order its observation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries
from ..operators import atomize, star_load
from ..storage import stored
from .base import query, t
from .postings import _pick, _values

ROLES = (("Data Engineer",), ("Back-end Developer", "Tester"), ("QA Engineer",))
#: A skill of a record: its name, its declared category, and what becomes of it (group, name, category, issue).
SKILLS = (
    ("Java/React", "other", (("programming_language", "Java", "programming_language"), ("framework", "React", "framework_library")), None),
    ("C/C++", "programming_language", (("programming_language", "C", "programming_language"), ("programming_language", "C++", "programming_language")), None),
    ("CI/CD", "devops", (("core_skill", "CI/CD", "devops"),), None),
    ("InternalFoo/Bar", "tool", (), "unresolved_composite"),
    ("English", "other", (("foreign_language", "English", ""),), "foreign_language_tag_moved"),
    ("Fintech", "other", (), "business_domain_not_a_skill"),
    ("MysteryTech", "other", (("core_skill", "MysteryTech", "other"),), "category_needs_review"),
    ("Giao tiếp", "other", (("soft_skill", "Communication", ""),), "soft_skill_tag_moved"),
)
CITIES = (("HCMC", "Hồ Chí Minh"), ("Hà Nội", "Hà Nội"), (None, None))
LANGUAGES = (("English", "TOEIC 650"), ("unknown", None), ("Tiếng Nhật", "JLPT N2"), ("Korean", None))


def records(spark, d):
    """Normalised records: one for each order."""
    k = F.col("o_orderkey")
    roles = F.when(k % 3 == 0, F.array(*[F.lit(x) for x in ROLES[0]])).when(k % 3 == 1, F.array(*[F.lit(x) for x in ROLES[1]])).otherwise(F.array(*[F.lit(x) for x in ROLES[2]]))
    skill = F.struct(_pick([s[0] for s in SKILLS], k % 8).alias("name"), _pick([s[1] for s in SKILLS], k % 8).alias("category"))
    spoken = F.struct(_pick([x[0] for x in LANGUAGES], k % 4).alias("language"), F.when(k % 4 == 0, "TOEIC 650").when(k % 4 == 2, "JLPT N2").alias("level_text"))
    city = F.when(k % 5 == 0, "HCMC").when(k % 5 == 1, "Hà Nội")
    return t(spark, d, "orders").select(
        F.concat(F.lit("topdev:"), F.col("o_custkey").cast("string")).alias("job_id"),
        F.concat(F.lit("run-"), k.cast("string")).alias("crawl_run_id"),
        F.lit("topdev").alias("source"),
        F.col("o_custkey").cast("string").alias("source_job_id"),
        F.concat(F.lit("https://topdev.vn/jobs/"), F.col("o_custkey").cast("string")).alias("job_url"),
        F.col("o_orderdate").cast("timestamp").alias("observed_at"),
        F.lit("Engineer").alias("title"),
        F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit(" Company "), (F.col("o_custkey") % 50).cast("string"))).alias("company_name"),
        F.lit("text").alias("description"),
        F.lit(None).cast("string").alias("location_text"),
        F.lit("remote").alias("work_mode"),
        roles.alias("job_roles"),
        F.array_compact(F.array(city)).alias("cities"),
        F.array(F.lit("Senior")).alias("seniority_levels"),
        F.array().cast("array<string>").alias("soft_skills"),
        F.array(skill).alias("skills"),
        F.array(spoken).alias("foreign_languages"),
        F.lit("5.1").alias("normalization_version"),
        F.col("o_orderdate").cast("timestamp").alias("normalized_at"),
    )


ATOMS_SQL = f"""roles AS (SELECT * FROM {_values([(k, r) for k, names in enumerate(ROLES) for r in names])} AS v(k, name)),
  skills AS (SELECT * FROM {_values([(k, *a) for k, s in enumerate(SKILLS) for a in s[2]])} AS v(k, grp, name, category)),
  issues AS (SELECT * FROM {_values([(k, s[3]) for k, s in enumerate(SKILLS) if s[3]])} AS v(k, reason)),
  cities AS (SELECT * FROM {_values([(0, "Hồ Chí Minh"), (1, "Hà Nội")])} AS v(k, name)),
  langs AS (SELECT * FROM {_values([(0, "English", "TOEIC 650"), (2, "Japanese", "JLPT N2"), (3, "Korean", None)])} AS v(k, name, level)),
  atoms AS (SELECT o_orderkey AS o, 'role' AS grp, name, '' AS category, NULL AS level FROM orders JOIN roles ON k = o_orderkey % 3
    UNION ALL SELECT o_orderkey, grp, name, category, NULL FROM orders JOIN skills ON k = o_orderkey % 8
    UNION ALL SELECT o_orderkey, 'city', name, '', NULL FROM orders JOIN cities ON k = o_orderkey % 5
    UNION ALL SELECT o_orderkey, 'level', 'Senior', '', NULL FROM orders
    UNION ALL SELECT o_orderkey, 'foreign_language', name, '', level FROM orders JOIN langs ON k = o_orderkey % 4)"""


@query(f'WITH {ATOMS_SQL} SELECT grp AS "group", name, category, level AS level_text, count(DISTINCT o) AS n FROM atoms GROUP BY 1, 2, 3, 4')
def atom_values(spark, d):
    values, _ = atomize.atomize_records(records(spark, d))
    return values.groupBy("group", "name", "category", "level_text").agg(F.countDistinct("observation_key").alias("n"))


@query(f"""WITH {ATOMS_SQL} SELECT reason, count(*) AS n FROM (SELECT reason FROM orders JOIN issues ON k = o_orderkey % 8 UNION ALL SELECT 'source_did_not_specify_language' FROM orders WHERE o_orderkey % 4 = 1) GROUP BY 1""")
def atom_issues(spark, d):
    _, found = atomize.atomize_records(records(spark, d))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN o_orderkey % 4 <> 1 OR o_orderkey % 8 = 4 THEN 'known' ELSE 'unknown' END AS foreign_language_status, count(*) AS n FROM orders GROUP BY 1")
def atom_language_status(spark, d):
    rows = records(spark, d)
    return atomize.observations(rows, atomize.atomize_records(rows)[0]).groupBy("foreign_language_status").agg(F.count(F.lit(1)).alias("n"))


def _loaded(spark, d):
    rows = records(spark, d)
    values = stored(atomize.atomize_records(rows)[0], "atom-values")
    return star_load.bootstrap(spark), stored(atomize.observations(rows, values), "atom-observations"), values


STAR_SQL = f"""{ATOMS_SQL},
  need AS (SELECT DISTINCT o, grp, name, category, level FROM atoms WHERE grp IN ('core_skill', 'foreign_language', 'framework', 'programming_language')),
  rc AS (SELECT o_orderkey AS o, greatest((SELECT count(*) FROM roles WHERE k = o_orderkey % 3), 1) * greatest((SELECT count(*) FROM cities WHERE k = o_orderkey % 5), 1) AS n FROM orders)"""


@query(f"""WITH {STAR_SQL}, c AS (
  SELECT 'dim_date' AS "table", (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders) AS n UNION ALL SELECT 'dim_source', 1
  UNION ALL SELECT 'dim_company', (SELECT count(DISTINCT o_custkey % 50) FROM orders WHERE o_custkey % 10 <> 0)
  UNION ALL SELECT 'dim_crawl_run', (SELECT count(*) FROM orders) UNION ALL SELECT 'dim_job', (SELECT count(DISTINCT o_custkey) FROM orders)
  UNION ALL SELECT 'dim_skill', (SELECT count(DISTINCT (grp, name)) FROM atoms WHERE grp IN ('core_skill', 'foreign_language', 'framework', 'programming_language', 'soft_skill'))
  UNION ALL SELECT 'dim_role', (SELECT count(DISTINCT name) FROM atoms WHERE grp = 'role') UNION ALL SELECT 'dim_city', (SELECT count(DISTINCT name) FROM atoms WHERE grp = 'city')
  UNION ALL SELECT 'dim_proficiency_level', (SELECT count(DISTINCT level) FROM atoms) UNION ALL SELECT 'fact_job_observation', (SELECT count(*) FROM orders)
  UNION ALL SELECT 'fact_job_necessary_skill', (SELECT count(*) FROM need) UNION ALL SELECT 'fact_job_role_city', (SELECT sum(n) FROM rc))
  SELECT "table", CAST(n AS BIGINT) AS rows_added FROM c""")
def star_load_counts(spark, d):
    before, observed, values = _loaded(spark, d)
    return star_load.added(before, star_load.load(before, observed, values))


@query("SELECT CAST(o_custkey AS VARCHAR) AS source_job_id, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen FROM orders GROUP BY 1")
def star_first_last_seen(spark, d):
    """The second half of the orders is loaded before the first half: what is late moves the first sight back."""
    rows = records(spark, d)
    values, _ = atomize.atomize_records(rows)
    observed = atomize.observations(rows, values)
    jobs = star_load.bootstrap(spark)["dim_job"]
    for late in (False, True):
        part = observed.where((F.dayofmonth("observed_at") <= 15) == late)
        jobs = star_load.merged_jobs(jobs, star_load.new_dimensions(part, values)["dim_job"].select(*jobs.columns))
    return jobs.select("source_job_id", F.col("first_seen_at_utc").alias("first_seen"), F.col("last_seen_at_utc").alias("last_seen"))


@query(f"""WITH {STAR_SQL} SELECT grp AS skill_type, name AS skill_name, level AS level_text, CAST(context_no AS INTEGER) AS context_no, count(*) AS n FROM
  (SELECT *, row_number() OVER (PARTITION BY o, grp, name, category ORDER BY level NULLS FIRST) - 1 AS context_no FROM need) GROUP BY 1, 2, 3, 4""")
def star_skill_facts(spark, d):
    _, observed, values = _loaded(spark, d)
    facts = star_load.new_facts(observed, values)["fact_job_necessary_skill"]
    names = star_load.new_dimensions(observed, values)["dim_skill"].select("skill_key", "skill_type", "skill_name")
    return facts.join(names, "skill_key").groupBy("skill_type", "skill_name", F.col("level_text_snapshot").alias("level_text"), "context_no").agg(F.count(F.lit(1)).alias("n"))


#: Every core skill, framework and role with its category, and names that have none.
NATURAL = (
    [("core_skill", name, category) for category, names in dictionaries.CORE_SKILLS.items() for name in names]
    + [("framework", name, language) for language, names in dictionaries.FRAMEWORK_LANGUAGES.items() for name in names]
    + [("role", name, category) for category, names in dictionaries.ROLE_CATEGORIES.items() for name in names]
    + [("core_skill", "Docker", "declared"), ("framework", "MVVM", None), ("framework", "Unknown Thing", None), ("role", "Tester", "Software Engineer"), ("role", "Game Designer", "Software Engineer")]
)


@query(f"""SELECT kind, category, count(*) AS n, count(DISTINCT v.name) AS names FROM part JOIN (SELECT *, row_number() OVER () - 1 AS k FROM {_values(NATURAL)} AS v(kind, name, category)) v ON v.k = p_partkey % {len(NATURAL)} GROUP BY 1, 2""")
def natural_categories(spark, d):
    """Category of core skills, language of frameworks, category of roles: each part stands for a name, written in its own case and blanks."""
    names = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name")) for kind, name, _ in NATURAL])
    written = F.concat(F.lit(" "), F.when(F.col("p_size") % 2 == 0, F.upper("x.name")).otherwise(F.col("x.name")))
    rows = t(spark, d, "part").select(F.element_at(names, (F.col("p_partkey") % len(NATURAL) + 1).cast("int")).alias("x"), "p_size").select("x.kind", "x.name", written.alias("written"))
    category = (
        F.when(F.col("kind") == "core_skill", atomize.core_skill_category(F.col("written"), F.lit("declared")))
        .when(F.col("kind") == "framework", atomize.framework_language(F.col("written")))
        .otherwise(atomize.role_category(F.col("written")))
    )
    return rows.groupBy("kind", category.alias("category")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("name").alias("names"))
