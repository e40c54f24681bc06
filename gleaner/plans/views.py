"""The views, over a model in which customers are jobs, orders their observations, and lines the values of eight groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import latest, quality, star, sync, views
from ..storage import partitions
from .base import query, register, t

OBSERVED_SQL = "obs AS (SELECT o_orderkey AS observation_key, o_custkey AS job_id, o_orderpriority AS crawl_run_id, o_orderdate AS observed_at, o_orderstatus AS work_mode, o_totalprice AS price FROM orders)"
LATEST_SQL = "newest AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY observed_at DESC, crawl_run_id DESC, observation_key DESC) AS rn FROM obs) WHERE rn = 1)"
#: Each group's name and category, as expressions that both engines read.
GROUPS = {
    "programming_language": ("p_brand", "'programming_language'"),
    "framework": ("p_type", "'framework_library'"),
    "core_skill": ("CAST(p_size AS VARCHAR(9))", "p_brand"),
    "role": ("CAST(l_linenumber AS VARCHAR(9))", "''"),
    "city": ("CAST(l_suppkey % 25 AS VARCHAR(9))", "''"),
    "foreign_language": ("l_returnflag", "''"),
    "level": ("l_linestatus", "''"),
    "soft_skill": ("CAST(l_suppkey % 4 AS VARCHAR(9))", "''"),
}


def bridge_sql(group: str) -> str:
    name, category = GROUPS[group]
    return f"(SELECT DISTINCT l_orderkey AS observation_key, {name} AS name, {category} AS category FROM lineitem JOIN part ON l_partkey = p_partkey)"


def observed(spark, d):
    rows = t(spark, d, "orders").select(
        F.col("o_orderkey").alias("observation_key"), F.col("o_custkey").alias("job_id"), F.col("o_orderpriority").alias("crawl_run_id"), F.col("o_orderdate").alias("observed_at"), F.col("o_orderstatus").alias("work_mode"), F.col("o_totalprice").alias("price")
    )
    return rows


def newest(spark, d):
    return views.fact_job_latest(observed(spark, d), "observation_key")


def bridge(spark, d, group):
    """The values of a group, each once an observation. Lines are dealt out before they are joined and made distinct, in as many
    partitions as they need: nearly every line is a row of its own, so there is nothing to sum up before they are. Parts are dealt out too:
    where they are too many to be broadcast, the lines that meet them follow."""
    name, category = (F.expr(x.replace("VARCHAR(9)", "STRING")) for x in GROUPS[group])
    li = t(spark, d, "lineitem")
    n = partitions(li)
    needs_part = any("p_" in x for x in GROUPS[group])
    rows = li.join(t(spark, d, "part").repartition(n, "p_partkey"), li.l_partkey == F.col("p_partkey")) if needs_part else li
    return rows.select(F.col("l_orderkey").alias("observation_key"), name.alias("name"), category.alias("category")).repartition(n, "observation_key").distinct()


def _of_newest(spark, d, rows):
    return views.bridge_latest(observed(spark, d), rows, "observation_key")


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT * FROM newest")
def view_fact_job_latest(spark, d):
    return newest(spark, d)


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT job_id, l_linenumber AS field_no, l_partkey AS source_value, 'discount_needs_review' AS reason FROM newest JOIN lineitem ON l_orderkey = observation_key WHERE l_discount > 0.08")
def view_review_queue(spark, d):
    issues = t(spark, d, "lineitem").where("l_discount > 0.08").select(F.col("l_orderkey").alias("observation_key"), F.col("l_linenumber").alias("field_no"), F.col("l_partkey").alias("source_value"), F.lit("discount_needs_review").alias("reason"))
    return _of_newest(spark, d, issues).select("job_id", "field_no", "source_value", "reason")


def _bridge_latest(group):
    return lambda spark, d: _of_newest(spark, d, bridge(spark, d, group)).select("job_id", "name", "category")


def _demand_latest(group):
    return lambda spark, d: views.demand_latest(observed(spark, d), bridge(spark, d, group), "observation_key")


def _job_values(group):
    def values(spark, d):
        rows = bridge(spark, d, group).join(observed(spark, d).select("observation_key", "job_id"), "observation_key")
        return rows.select("job_id", "name", "category").repartition(partitions(t(spark, d, "lineitem")), "job_id").groupBy("job_id", "name", "category").agg(F.count(F.lit(1)).alias("n_observations"))

    return values


for _group in GROUPS:
    register(f"view_bridge_{_group}_latest", _bridge_latest(_group), f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT job_id, name, category FROM newest JOIN {bridge_sql(_group)} USING (observation_key)")
    register(
        f"view_{_group}_demand_latest",
        _demand_latest(_group),
        f"""WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT name, category, count(DISTINCT job_id) AS job_count, (SELECT count(*) FROM newest) AS total_jobs,
        CAST(round(100.0 * count(DISTINCT job_id) / (SELECT count(*) FROM newest), 2) AS DOUBLE) AS job_percent FROM newest JOIN {bridge_sql(_group)} USING (observation_key) GROUP BY 1, 2""",
    )
    register(f"view_dw_job_{_group}", _job_values(_group), f"WITH {OBSERVED_SQL} SELECT job_id, name, category, count(*) AS n_observations FROM obs JOIN {bridge_sql(_group)} USING (observation_key) GROUP BY 1, 2, 3")

SKILL_GROUPS = ("programming_language", "framework", "core_skill")
_SKILLS_SQL = " UNION ALL ".join(f"SELECT *, '{g}' AS skill_group FROM {bridge_sql(g)}" for g in SKILL_GROUPS)


def _skills(spark, d):
    return views.union_of_groups({g: bridge(spark, d, g) for g in SKILL_GROUPS}).withColumnRenamed("group", "skill_group")


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT job_id, skill_group, name, category FROM newest JOIN ({_SKILLS_SQL}) USING (observation_key)")
def view_job_skills_latest(spark, d):
    return _of_newest(spark, d, _skills(spark, d)).select("job_id", "skill_group", "name", "category")


@query(f"""WITH {OBSERVED_SQL}, {LATEST_SQL}, roles AS (SELECT job_id, observation_key, name AS role FROM newest JOIN {bridge_sql('role')} USING (observation_key)),
    totals AS (SELECT role, count(DISTINCT job_id) AS role_jobs FROM roles GROUP BY 1)
    SELECT role, name AS skill, count(DISTINCT job_id) AS skill_jobs, role_jobs, CAST(round(100.0 * count(DISTINCT job_id) / role_jobs, 2) AS DOUBLE) AS skill_percent
    FROM roles JOIN {bridge_sql('programming_language')} USING (observation_key) JOIN totals USING (role) GROUP BY role, name, role_jobs""")
def view_role_skill_demand_latest(spark, d):
    roles = _of_newest(spark, d, bridge(spark, d, "role")).select("job_id", F.col("name").alias("role"))
    skills = _of_newest(spark, d, bridge(spark, d, "programming_language")).select("job_id", F.col("name").alias("skill"))
    return star.two_level_demand(skills, roles, "job_id", "role", "skill")


# -- star views: decoded facts -----------------------------------------------------------------------------------
@query("""SELECT o_orderkey AS observation_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, dayname(o_orderdate) AS day_name, c_name AS company_name, n_name AS city_name, r_name AS source_name, o_orderpriority AS crawl_run_id, o_totalprice AS price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def view_semantic_job_observation(spark, d):
    o = t(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    days = o.select("day").distinct().select("day", F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"), F.date_format("day", "EEEE").alias("day_name"))
    runs = o.select("o_orderpriority").distinct().withColumn("crawl_run_id", F.col("o_orderpriority"))
    dims = {
        "company": (t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("company_name"), F.col("c_nationkey").alias("n_nationkey")), ["o_custkey"]),
        "city": (t(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("city_name"), F.col("n_regionkey").alias("r_regionkey")), ["n_nationkey"]),
        "source": (t(spark, d, "region").select("r_regionkey", F.col("r_name").alias("source_name")), ["r_regionkey"]),
        "date": (days, ["day"]),
        "run": (runs, ["o_orderpriority"]),
    }
    return views.decoded(o, dims).select(F.col("o_orderkey").alias("observation_id"), "date_key", "day_name", "company_name", "city_name", "source_name", "crawl_run_id", F.col("o_totalprice").alias("price"))


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT job_id, c_name AS company_name, observed_at, work_mode FROM newest JOIN customer ON c_custkey = job_id")
def view_semantic_latest_job(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("company_name"))
    return newest(spark, d).join(c, "job_id").select("job_id", "company_name", "observed_at", "work_mode")


_FACT_SKILL = "l_orderkey AS observation_id, l_linenumber AS context_no, p_name AS skill_name, p_brand AS category, s_name AS source_name, n_name AS level_name"


@query(f"SELECT {_FACT_SKILL}, o_custkey AS job_id, CAST(o_orderdate AS DATE) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey")
def view_semantic_job_skill(spark, d):
    li, o, p, s, n = (t(spark, d, x) for x in ("lineitem", "orders", "part", "supplier", "nation"))
    joined = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    return joined.select(F.col("l_orderkey").alias("observation_id"), F.col("l_linenumber").alias("context_no"), F.col("p_name").alias("skill_name"), F.col("p_brand").alias("category"), F.col("s_name").alias("source_name"), F.col("n_name").alias("level_name"), F.col("o_custkey").alias("job_id"), F.to_date("o_orderdate").alias("day"))


_ROLE_CITY_SQL = f"SELECT o_orderkey AS observation_id, o_custkey AS job_id, coalesce(r.name, 'Unknown') AS role_name, coalesce(c.name, 'Unknown') AS city_name FROM orders LEFT JOIN {bridge_sql('role')} r ON r.observation_key = o_orderkey LEFT JOIN (SELECT * FROM {bridge_sql('city')} WHERE name < '2') c ON c.observation_key = o_orderkey"


def _role_city(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("observation_key"), F.col("o_custkey").alias("job_id"))
    roles = bridge(spark, d, "role").select("observation_key", F.col("name").alias("role_name"))
    cities = bridge(spark, d, "city").where("name < '2'").select("observation_key", F.col("name").alias("city_name"))
    known = lambda c: F.coalesce(c, F.lit("Unknown")).alias(c)
    return star.combinations(o, roles, cities, "observation_key").select(F.col("observation_key").alias("observation_id"), "job_id", known("role_name"), known("city_name"))


@query(_ROLE_CITY_SQL)
def view_semantic_job_role_city(spark, d):
    return _role_city(spark, d)


@query(f"SELECT role_name, city_name, count(*) AS combinations, count(DISTINCT job_id) AS jobs FROM ({_ROLE_CITY_SQL}) GROUP BY 1, 2")
def view_dw_job_role_city(spark, d):
    """A job's combinations are one row each before jobs are counted; they are dealt out by job, in as many partitions as the lines need."""
    rows = _role_city(spark, d).select("job_id", "role_name", "city_name").repartition(partitions(t(spark, d, "lineitem")), "job_id")
    of_job = rows.groupBy("job_id", "role_name", "city_name").agg(F.count(F.lit(1)).alias("combinations"))
    return of_job.groupBy("role_name", "city_name").agg(F.sum("combinations").alias("combinations"), F.count("job_id").alias("jobs"))


@query("""SELECT l_orderkey AS observation_id, l_linenumber AS context_no, p_name AS skill_name, x.level_name FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_partkey AS s, 'certified' AS level_name FROM lineitem WHERE l_quantity > 40) x ON x.k = l_orderkey AND x.s = l_partkey""")
def view_dw_job_necessary_skill(spark, d):
    """Left join on a composite key: a line's level, if its order and part have one."""
    li, p = t(spark, d, "lineitem"), t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("skill_name"))
    levels = li.where("l_quantity > 40").select("l_orderkey", "l_partkey").distinct().withColumn("level_name", F.lit("certified"))
    return li.select("l_orderkey", "l_partkey", "l_linenumber").join(p, "l_partkey").join(levels, ["l_orderkey", "l_partkey"], "left").select(F.col("l_orderkey").alias("observation_id"), F.col("l_linenumber").alias("context_no"), "skill_name", "level_name")


# -- compatible views: the star in the columns of its predecessor ------------------------------------------------
@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT 'topdev:' || CAST(job_id AS VARCHAR) AS job_id, c_name AS company_name, n_name AS source, observed_at FROM newest JOIN customer ON c_custkey = job_id JOIN nation ON n_nationkey = c_nationkey")
def view_compat_fact_job(spark, d):
    c, n = t(spark, d, "customer"), t(spark, d, "nation")
    joined = newest(spark, d).join(c, F.col("job_id") == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.select(F.concat(F.lit("topdev:"), F.col("job_id").cast("string")).alias("job_id"), F.col("c_name").alias("company_name"), F.col("n_name").alias("source"), "observed_at")


@query(f"SELECT DISTINCT skill_group, name, category, lower(trim(name)) AS normalized_name FROM ({_SKILLS_SQL})")
def view_compat_dim_necessary_skill(spark, d):
    return _skills(spark, d).select("skill_group", "name", "category", F.lower(F.trim("name")).alias("normalized_name")).distinct()


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE EXISTS (SELECT 1 FROM newest WHERE observation_key = l_orderkey)")
def view_compat_fact_job_necessary_skill(spark, d):
    keys = newest(spark, d).select(F.col("observation_key").alias("l_orderkey"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(keys, "l_orderkey", "left_semi")


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT job_id, p_name AS skill_name, count(*) AS mentions, CAST(sum(l_linenumber) AS BIGINT) AS measure FROM newest JOIN lineitem ON l_orderkey = observation_key JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def view_compat_job_necessary_skill(spark, d):
    li = t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "observation_key")
    joined = _of_newest(spark, d, li).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("job_id", F.col("p_name").alias("skill_name")).agg(F.count(F.lit(1)).alias("mentions"), F.sum("l_linenumber").alias("measure"))


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT x.observation_id, x.role_name, x.city_name FROM ({_ROLE_CITY_SQL}) x JOIN newest ON observation_key = x.observation_id")
def view_compat_fact_job_role_city(spark, d):
    keys = newest(spark, d).select(F.col("observation_key").alias("observation_id"))
    return _role_city(spark, d).drop("job_id").join(keys, "observation_id", "left_semi")


@query(f"WITH {OBSERVED_SQL}, {LATEST_SQL} SELECT x.job_id, x.role_name, x.city_name, count(*) AS n FROM ({_ROLE_CITY_SQL}) x JOIN newest ON observation_key = x.observation_id GROUP BY 1, 2, 3")
def view_compat_job_role_city(spark, d):
    keys = newest(spark, d).select(F.col("observation_key").alias("observation_id"))
    return _role_city(spark, d).join(keys, "observation_id", "left_semi").groupBy("job_id", "role_name", "city_name").agg(F.count(F.lit(1)).alias("n"))


# -- filters, lookups, joins that the views lean on --------------------------------------------------------------
@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 7 AND o_orderstatus = 'O'")
def scope_filter_and_lookup(spark, d):
    """A scope whose absent parts don't count, and a lookup of one key."""
    return views.point_lookup(views.scope(t(spark, d, "orders"), o_orderstatus="O", o_orderpriority=None), o_custkey=7).select("o_orderkey", "o_custkey")


@query("""SELECT o_orderkey, 'Order at ' || c_name || ' on ' || strftime(o_orderdate, '%d/%m/%Y') || ' for $' || format('{:,.2f}', o_totalprice) AS sentence FROM orders JOIN customer ON o_custkey = c_custkey""")
def business_sentence(spark, d):
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("title", F.lit("Order"))
    return rows.select("o_orderkey", views.sentence("title", "c_name", "o_orderdate", "o_totalprice").alias("sentence"))


@query("""SELECT p_partkey, 'brand' AS "group", p_brand AS label, lower(p_brand) AS derived FROM part WHERE p_size < 5 UNION ALL
    SELECT p_partkey, 'type', p_type, upper(p_type) FROM part WHERE p_size < 5""")
def group_projections(spark, d):
    p = t(spark, d, "part").where("p_size < 5")
    values = p.select("p_partkey", F.lit("brand").alias("group"), F.col("p_brand").alias("label")).unionByName(p.select("p_partkey", F.lit("type").alias("group"), F.col("p_type").alias("label")))
    return views.by_group(values, {"brand": [F.lower("label").alias("derived")], "type": [F.upper("label").alias("derived")]})


@query("""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(isodow(o_orderdate) AS INTEGER) AS dow, CAST(isodow(o_orderdate) AS INTEGER) >= 6 AS weekend FROM orders""")
def lateral_date_parts(spark, d):
    """Scalars worked out once a row and used by later ones."""
    day = t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")).withColumn("dow", F.weekday("day") + 1)
    return day.select("o_orderkey", F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"), "dow", (F.col("dow") >= 6).alias("weekend"))


@query("""WITH a AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE left(n_name, 1) END AS x FROM nation),
  b AS (SELECT CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE chr(CAST(65 + s_suppkey % 26 AS INTEGER)) END AS y FROM supplier)
  SELECT n_nationkey, x, count(*) AS n FROM a JOIN b ON coalesce(x, '') = coalesce(y, '') GROUP BY 1, 2""")
def match_empty_as_null(spark, d):
    """Two columns that count null and the empty text as one meet; the larger side is counted first, so its empty ones are one row."""
    k, s = F.col("n_nationkey"), F.col("s_suppkey")
    a = t(spark, d, "nation").select("n_nationkey", F.when(k % 4 == 1, "").when(k % 4 > 1, F.substring("n_name", 1, 1)).alias("x"))
    b = t(spark, d, "supplier").select(F.when(s % 5 == 1, "").when(s % 5 > 1, F.char(65 + s % 26)).alias("y"))
    counted = b.groupBy(F.coalesce("y", F.lit("")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    return a.withColumn("m", F.coalesce("x", F.lit(""))).join(counted, "m").select("n_nationkey", "x", "n")


@query("""WITH a AS (SELECT l_orderkey, list(DISTINCT l_linestatus ORDER BY l_linestatus) AS levels FROM lineitem WHERE l_quantity > 10 GROUP BY 1) SELECT l_orderkey, array_to_string(levels, '|') AS levels FROM a""")
def sorted_levels(spark, d):
    rows = t(spark, d, "lineitem").where("l_quantity > 10")
    return rows.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_linestatus")), "|").alias("levels"))


@query("""SELECT (SELECT count(*) FROM lineitem) AS n_rows, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS jobs, (SELECT CAST(sum(l_linenumber) AS BIGINT) FROM lineitem) AS measure""")
def global_totals(spark, d):
    return t(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("l_orderkey").alias("jobs"), F.sum("l_linenumber").alias("measure"))


@query("""SELECT l.l_orderkey, l.l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey = l.l_orderkey AND c.c_nationkey = l.l_suppkey % 25
    AND CAST(strftime(o.o_orderdate, '%Y') AS INTEGER) = CAST(strftime(l.l_shipdate, '%Y') AS INTEGER) AND o.o_orderstatus IS NOT DISTINCT FROM l.l_linestatus)""")
def lineage_orphans_many_keys(spark, d):
    """Lines without a parent that agrees on four keys."""
    o, c, li = t(spark, d, "orders"), t(spark, d, "customer"), t(spark, d, "lineitem")
    parents = o.join(c, o.o_custkey == c.c_custkey).select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").cast("long").alias("k"), F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("s"))
    rows = li.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 25).alias("k"), F.year("l_shipdate").alias("y"), F.col("l_linestatus").alias("s"))
    return rows.join(parents, ["l_orderkey", "k", "y", "s"], "left_anti").select("l_orderkey", "l_linenumber")


@query(f"""WITH {OBSERVED_SQL}, {LATEST_SQL}, r AS (
    SELECT 'mapping_complete' AS check_name, 0 AS expected, (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) AS actual, 'eq' AS kind
    UNION ALL SELECT 'no_collapse', (SELECT count(DISTINCT p_name) FROM part), (SELECT count(DISTINCT lower(p_name)) FROM part), 'eq'
    UNION ALL SELECT 'no_collision', 0, (SELECT count(*) FROM (SELECT lower(trim(c_mktsegment)) FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1)), 'eq'
    UNION ALL SELECT 'history_covers_snapshot', (SELECT count(*) FROM newest), (SELECT count(*) FROM obs), 'ge'
    UNION ALL SELECT 'view_equals_table', (SELECT count(*) FROM orders), (SELECT count(*) FROM obs), 'eq'
    UNION ALL SELECT 'latest_equals_jobs', (SELECT count(DISTINCT o_custkey) FROM orders), (SELECT count(*) FROM newest), 'eq'
    UNION ALL SELECT 'same_attributes', 0, (SELECT count(*) FROM orders JOIN obs ON o_orderkey = observation_key WHERE o_totalprice IS DISTINCT FROM price), 'eq'
    UNION ALL SELECT 'not_empty', 1, (SELECT count(*) FROM orders), 'ge')
    SELECT check_name, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, CASE WHEN (kind = 'eq' AND expected = actual) OR (kind = 'ge' AND actual >= expected) THEN 'pass' ELSE 'fail' END AS status FROM r""")
def publish_gates(spark, d):
    o, p, li, c = (t(spark, d, x) for x in ("orders", "part", "lineitem", "customer"))
    seen, snapshot = observed(spark, d), newest(spark, d)
    names = p.select("p_name")
    segments = c.groupBy(F.lower(F.trim("c_mktsegment")).alias("k")).agg(F.countDistinct("c_mktsegment").alias("n")).where("n > 1")
    return quality.report(
        quality.mapping_complete("mapping_complete", li, p.select(F.col("p_partkey").alias("l_partkey")), ["l_partkey"]),
        quality.no_collapse("no_collapse", names, names.select(F.lower("p_name").alias("k")), ["k"]),
        quality.none_of("no_collision", segments),
        quality.at_least("history_covers_snapshot", seen, snapshot),
        quality.same_count("view_equals_table", o, seen),
        quality.same_count("latest_equals_jobs", o.select("o_custkey").distinct(), snapshot),
        quality.same_attributes("same_attributes", o.select(F.col("o_orderkey").alias("observation_key"), F.col("o_totalprice").alias("price")), seen, ["observation_key"], ["price"]),
        quality.not_empty("not_empty", o),
    )


@query("""WITH a AS (SELECT l_partkey AS v, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) AS rn, l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_linenumber = 1),
    b AS (SELECT l_partkey AS v, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) AS rn FROM lineitem WHERE l_linenumber = 2)
    SELECT b.v AS l_partkey, count(*) AS wanted, count(a.v) AS kept FROM b LEFT JOIN a ON a.v = b.v AND a.rn = b.rn GROUP BY 1""")
def dimension_sync_keeps_ids(spark, d):
    """Equal values keep as many stored ids as there are."""
    li = t(spark, d, "lineitem")
    stored = li.where("l_linenumber = 1").select("l_partkey", F.monotonically_increasing_id().alias("id"))
    wanted = li.where("l_linenumber = 2").select("l_partkey")
    return sync.keep_ids(stored, wanted, ["l_partkey"], "id").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("wanted"), F.count("id").alias("kept"))
