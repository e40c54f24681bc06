"""Warehouse-shaped queries: history and latest views, star joins, demand, synchronisation and gates.

The driver's tables stand in for the posting model: events are observations (user = job), orders are job facts,
lineitem the skill facts, part the skills, customer the companies, nation the cities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import latest, quality, star, sync
from ..storage import partitions
from .base import query, t

DAY_SPLIT = "2024-01-16"


def _latest_events(spark: SparkSession, d: str) -> DataFrame:
    return latest.latest_by(t(spark, d, "events"), ["user_id"], "ts", "event_id")


LATEST_SQL = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)"


@query("SELECT user_id, event_id, ts, event_type, value FROM " + LATEST_SQL)
def latest_observation(spark, d):
    return _latest_events(spark, d).select("user_id", "event_id", "ts", "event_type", "value")


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def earliest_claim(spark, d):
    e = t(spark, d, "events")
    registry = spark.createDataFrame([], "user_id long")
    return sync.claim_first(registry, e, "user_id", [F.col("ts").asc(), F.col("event_id").asc()]).select("user_id", "event_id", "ts")


@query("""SELECT o_orderkey, o_orderdate, c_name FROM orders JOIN customer ON o_custkey = c_custkey
          WHERE o_orderstatus <> 'P' AND c_mktsegment = 'BUILDING' ORDER BY o_orderdate, o_orderkey LIMIT 500""")
def run_scope_filter_limit(spark, d):
    o, c = t(spark, d, "orders"), t(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    rows = o.where("o_orderstatus <> 'P'").join(c, o.o_custkey == c.c_custkey)
    return rows.select("o_orderkey", "o_orderdate", "c_name").orderBy("o_orderdate", "o_orderkey").limit(500)


@query("""SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def dedupe_keep_lowest(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return latest.first_by(rows, ["l_orderkey", "l_linenumber"], [F.col("l_partkey").asc()])


@query("""SELECT l_orderkey, level, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY level NULLS FIRST) - 1 AS INTEGER) AS context_no
          FROM (SELECT l_orderkey, nullif(l_returnflag, 'N') AS level FROM lineitem)""")
def context_no(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", F.nullif("l_returnflag", F.lit("N")).alias("level"))
    return latest.context_numbers(rows, ["l_orderkey"], "level")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def existing_ids_semi(spark, d):
    ids = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return t(spark, d, "customer").select("c_custkey", "c_name").join(ids, "c_custkey", "left_semi")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def missing_ids_anti(spark, d):
    ids = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return t(spark, d, "customer").select("c_custkey", "c_name").join(ids, "c_custkey", "left_anti")


@query("""SELECT o_orderkey, o_orderdate, c_name, c_mktsegment, n_name, r_name FROM orders
          JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def observation_star(spark, d):
    o, c, n, r = (t(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.select("o_orderkey", "o_orderdate", "c_name", "c_mktsegment", "n_name", "r_name")


@query("""SELECT p_type AS category, s_name, n_name, count(*) AS mentions, sum(l_quantity) AS quantity FROM lineitem
          JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
          JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY ALL""")
def skill_star(spark, d):
    li, p, s, n, o = (t(spark, d, x) for x in ("lineitem", "part", "supplier", "nation", "orders"))
    joined = li.join(o.where("o_orderstatus = 'F'"), li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
    joined = joined.join(n, s.s_nationkey == n.n_nationkey)
    return joined.groupBy(F.col("p_type").alias("category"), "s_name", "n_name").agg(F.count(F.lit(1)).alias("mentions"), F.sum("l_quantity").alias("quantity"))


@query("""WITH roles AS (SELECT DISTINCT l_orderkey AS k, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 25),
          cities AS (SELECT DISTINCT l_orderkey AS k, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey < 12)
          SELECT o_orderkey, count(*) AS n_rows, count(DISTINCT p_brand) AS n_roles, count(DISTINCT s_nationkey) AS n_cities
          FROM orders LEFT JOIN roles ON roles.k = o_orderkey LEFT JOIN cities ON cities.k = o_orderkey GROUP BY o_orderkey""")
def role_city_combinations(spark, d):
    li, p, s = (t(spark, d, x) for x in ("lineitem", "part", "supplier"))
    roles = li.join(p.where("p_size > 25"), li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("o_orderkey"), "p_brand").distinct()
    cities = li.join(s.where("s_nationkey < 12"), li.l_suppkey == s.s_suppkey).select(F.col("l_orderkey").alias("o_orderkey"), "s_nationkey").distinct()
    rows = star.combinations(t(spark, d, "orders").select("o_orderkey"), roles, cities, "o_orderkey")
    return rows.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("p_brand").alias("n_roles"), F.countDistinct("s_nationkey").alias("n_cities"))


@query("""SELECT coalesce(c_custkey + 1, 0) AS company_key, coalesce(c_name, 'Unknown') AS company, count(*) AS n FROM orders
          LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey GROUP BY 1, 2""")
def unknown_member_decode(spark, d):
    known = t(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") + 1).alias("company_key"), "c_name")
    rows = star.with_key(t(spark, d, "orders").select("o_custkey"), known, ["o_custkey"], "company_key")
    named = rows.join(known.select("company_key", "c_name"), "company_key", "left")
    return named.groupBy("company_key", F.coalesce("c_name", F.lit("Unknown")).alias("company")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_brand, n, nullif(max(coalesce(CASE WHEN p_size > 40 THEN p_name END, '')), '') AS largest_name FROM part
          JOIN (SELECT p_brand AS b, count(*) AS n FROM part GROUP BY 1) ON b = p_brand GROUP BY 1, 2""")
def agg_subquery_join(spark, d):
    p = t(spark, d, "part")
    counts = p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    name = F.coalesce(F.when(F.col("p_size") > 40, F.col("p_name")), F.lit(""))
    return p.groupBy("p_brand").agg(F.nullif(F.max(name), F.lit("")).alias("largest_name")).join(counts, "p_brand")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT EXISTS
          (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""")
def lineage_orphans(spark, d):
    parents = t(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(parents, "l_orderkey", "left_anti")


@query("""SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(o_orderdate AS DATE) AS calendar_date,
          CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, dayname(o_orderdate) AS day_name, CAST(month(o_orderdate) AS INTEGER) AS month_no,
          monthname(o_orderdate) AS month_name, CAST(quarter(o_orderdate) AS INTEGER) AS quarter_no, CAST(year(o_orderdate) AS INTEGER) AS year_no,
          isodow(o_orderdate) >= 6 AS is_weekend FROM orders""")
def dim_date(spark, d):
    day = F.to_date("o_orderdate")
    return (
        t(spark, d, "orders")
        .select(day.alias("calendar_date"))
        .distinct()
        .select(
            F.date_format("calendar_date", "yyyyMMdd").cast("int").alias("date_key"),
            "calendar_date",
            (F.weekday("calendar_date") + 1).alias("day_of_week"),
            F.date_format("calendar_date", "EEEE").alias("day_name"),
            F.month("calendar_date").alias("month_no"),
            F.date_format("calendar_date", "MMMM").alias("month_name"),
            F.quarter("calendar_date").alias("quarter_no"),
            F.year("calendar_date").alias("year_no"),
            (F.weekday("calendar_date") >= 5).alias("is_weekend"),
        )
    )


@query("SELECT event_type, count(DISTINCT user_id) AS job_count, (SELECT count(DISTINCT user_id) FROM events) AS total_jobs, "
       "CAST(round(100.0 * count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events), 2) AS DOUBLE) AS job_percent FROM " + LATEST_SQL + " GROUP BY 1")
def value_demand_latest(spark, d):
    found = _latest_events(spark, d)
    return star.demand(found, t(spark, d, "events"), "user_id", "event_type")


@query("""WITH r AS (SELECT o_orderkey, o_orderpriority AS role FROM orders), totals AS (SELECT role, count(DISTINCT o_orderkey) AS role_jobs FROM r GROUP BY 1),
          m AS (SELECT DISTINCT l_orderkey, p_brand AS skill FROM lineitem JOIN part ON l_partkey = p_partkey)
          SELECT role, skill, count(DISTINCT o_orderkey) AS skill_jobs, role_jobs, CAST(round(100.0 * count(DISTINCT o_orderkey) / role_jobs, 2) AS DOUBLE) AS skill_percent
          FROM r JOIN m ON l_orderkey = o_orderkey JOIN totals USING (role) GROUP BY role, skill, role_jobs""")
def role_skill_demand(spark, d):
    li, p = t(spark, d, "lineitem"), t(spark, d, "part")
    roles = t(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("role"))
    mentions = li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("o_orderkey"), F.col("p_brand").alias("skill"))
    return star.two_level_demand(mentions, roles, "o_orderkey", "role", "skill")


@query("""SELECT CAST(o_orderdate AS DATE) AS day, p_brand AS skill, count(*) AS mentions, count(DISTINCT l_orderkey) AS jobs, CAST(sum(l_linenumber) AS BIGINT) AS measure
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def skill_demand_daily(spark, d):
    """Lines are dealt out by order, in as many partitions as they need; an order's lines of a skill are one row before days and skills are
    summed up, so no task holds more than its share of the orders. Parts are dealt out too: where they are too many to be broadcast, the
    lines that meet them follow."""
    li, o, p = (t(spark, d, x) for x in ("lineitem", "orders", "part"))
    n = partitions(li)
    named = li.join(p.repartition(n, "p_partkey"), li.l_partkey == F.col("p_partkey")).select("l_orderkey", "l_linenumber", F.col("p_brand").alias("skill"))
    days = o.select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("day"))
    joined = named.repartition(n, "l_orderkey").join(days, "l_orderkey")
    of_order = joined.groupBy("l_orderkey", "day", "skill").agg(F.count(F.lit(1)).alias("mentions"), F.sum("l_linenumber").alias("measure"))
    return of_order.groupBy("day", "skill").agg(F.sum("mentions").alias("mentions"), F.count("l_orderkey").alias("jobs"), F.sum("measure").alias("measure"))


@query("""SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS role, n_name AS city, count(*) AS rows_, count(DISTINCT o_custkey) AS companies
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""")
def role_city_demand_daily(spark, d):
    o, c, n = (t(spark, d, x) for x in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("role"), F.col("n_name").alias("city")).agg(
        F.count(F.lit(1)).alias("rows_"), F.countDistinct("o_custkey").alias("companies")
    )


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def grain_duplicates(spark, d):
    return latest.repeated_grains(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT lower(trim(c_mktsegment)) AS normalized_name, min(c_mktsegment) AS name, min(c_name) AS first_company FROM customer GROUP BY 1")
def representative_name(spark, d):
    return t(spark, d, "customer").groupBy(tx.natural_key("c_mktsegment").alias("normalized_name")).agg(F.min("c_mktsegment").alias("name"), F.min("c_name").alias("first_company"))


@query("""SELECT user_id, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) ELSE 'multi' END AS source_scope, min(ts) AS started, max(ts) AS finished
          FROM events WHERE value > 90 GROUP BY 1""")
def run_scope_case(spark, d):
    one = F.when(F.countDistinct("event_type") == 1, F.min("event_type")).otherwise("multi")
    return t(spark, d, "events").where("value > 90").groupBy("user_id").agg(one.alias("source_scope"), F.min("ts").alias("started"), F.max("ts").alias("finished"))


@query("""SELECT p_type, count(*) AS n FROM part GROUP BY p_type HAVING NOT EXISTS (SELECT 1 FROM part x WHERE x.p_type = part.p_type AND x.p_size = 50 AND x.p_brand = 'Brand#11')""")
def having_not_exists(spark, d):
    p = t(spark, d, "part")
    return p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).join(p.where("p_size = 50 AND p_brand = 'Brand#11'").select("p_type"), "p_type", "left_anti")


@query("""SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linenumber <= 2 EXCEPT ALL SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linenumber = 3""")
def multiset_diff(spark, d):
    rows = t(spark, d, "lineitem")
    side = lambda cond: rows.where(cond).select("l_partkey", "l_returnflag")
    return sync.multiset_difference(side("l_linenumber <= 2"), side("l_linenumber = 3"))


@query("""WITH r AS (SELECT user_id, sha256(length(CAST(user_id AS VARCHAR)) || ':' || user_id || length(CAST(event_id AS VARCHAR)) || ':' || event_id || length(event_type) || ':' || event_type) AS h FROM events),
          p AS (SELECT user_id, h[1:2] AS p, sha256(string_agg(h, '' ORDER BY h)) AS d FROM r GROUP BY 1, 2)
          SELECT user_id, sha256(string_agg(p || d, '' ORDER BY p)) AS fingerprint FROM p GROUP BY 1""")
def content_fingerprint(spark, d):
    return quality.content_fingerprint(t(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"])


@query("""SELECT p_name AS name, p_type AS category, 'skill' AS kind FROM part WHERE p_size < 10 UNION ALL SELECT s_name, CAST(s_nationkey AS VARCHAR), 'supplier' FROM supplier""")
def job_skills_union(spark, d):
    skills = t(spark, d, "part").where("p_size < 10").select(F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.lit("skill").alias("kind"))
    others = t(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("category"), F.lit("supplier").alias("kind"))
    return skills.unionByName(others)


@query("""WITH a AS (SELECT user_id, event_type FROM events WHERE value > 50), b AS (SELECT user_id, event_type FROM events WHERE value < 60)
          SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def except_both_ways(spark, d):
    e = t(spark, d, "events")
    return quality.differences(e.where("value > 50").select("user_id", "event_type"), e.where("value < 60").select("user_id", "event_type"))


def _halves(spark, d):
    """The latest row of each user before and after DAY_SPLIT: what is stored and what comes in."""
    e = t(spark, d, "events").select("user_id", "event_type", "value", "ts", "event_id")
    pick = lambda df: latest.latest_by(df, ["user_id"], "ts", "event_id").drop("event_id")
    return pick(e.where(F.col("ts") < F.lit(DAY_SPLIT).cast("timestamp_ntz"))), pick(e.where(F.col("ts") >= F.lit(DAY_SPLIT).cast("timestamp_ntz")))


HALVES_SQL = f"""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts >= TIMESTAMP '{DAY_SPLIT}' ORDER BY ts DESC, event_id DESC) AS rn FROM events),
          s AS (SELECT user_id, event_type, value, ts FROM ranked WHERE rn = 1 AND ts < TIMESTAMP '{DAY_SPLIT}'),
          i AS (SELECT user_id, event_type, value, ts FROM ranked WHERE rn = 1 AND ts >= TIMESTAMP '{DAY_SPLIT}') """


@query(HALVES_SQL + """SELECT user_id, CASE WHEN keep THEN s.event_type ELSE i.event_type END AS event_type, CASE WHEN keep THEN s.ts ELSE i.ts END AS ts FROM
          (SELECT coalesce(s.user_id, i.user_id) AS user_id, s, i, i.user_id IS NULL OR (s.user_id IS NOT NULL AND s.event_type IS NOT DISTINCT FROM i.event_type) AS keep
           FROM s FULL JOIN i ON s.user_id = i.user_id)""")
def upsert_distinct_from(spark, d):
    s, i = _halves(spark, d)
    return sync.upsert(s, i, ["user_id"], ["event_type"], "ts")


@query(HALVES_SQL + "SELECT * FROM i UNION ALL SELECT * FROM s WHERE user_id NOT IN (SELECT user_id FROM i)")
def scd1_merge(spark, d):
    s, i = _halves(spark, d)
    return sync.scd1(s, i, ["user_id"])


@query(HALVES_SQL + "SELECT * FROM s UNION ALL SELECT i.* FROM i WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = i.user_id AND s.event_type = i.event_type)")
def append_by_grain(spark, d):
    s, i = _halves(spark, d)
    return sync.append_new(s, i, ["user_id", "event_type"])


@query(HALVES_SQL + "SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.user_id = s.user_id AND i.value < 50)")
def stale_delete(spark, d):
    s, i = _halves(spark, d)
    return sync.drop_rejected(s, i.where("value < 50"), ["user_id"])


@query(HALVES_SQL + """SELECT coalesce(s.user_id, i.user_id) AS user_id, CASE WHEN s.user_id IS NULL THEN 'insert' WHEN i.user_id IS NULL THEN 'delete'
          WHEN s.event_type = i.event_type THEN 'unchanged' ELSE 'update' END AS action FROM s FULL JOIN (SELECT * FROM i WHERE value > 20) i ON s.user_id = i.user_id""")
def sync_plan_kinds(spark, d):
    s, i = _halves(spark, d)
    return sync.sync_plan(s, i.where("value > 20"), ["user_id"], ["event_type"])


@query("""SELECT 'orders_with_customer' AS check_name, (SELECT count(*) FROM orders) AS expected, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS actual, NULL AS s
          UNION ALL SELECT 'lineitem_grain', 0, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), NULL
          UNION ALL SELECT 'lineitem_orphans', 0, (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)), NULL
          UNION ALL SELECT 'lines_sum', (SELECT sum(l_linenumber) FROM lineitem), (SELECT sum(l_linenumber) FROM lineitem JOIN part ON l_partkey = p_partkey), NULL""".replace(
    "SELECT 'orders_with_customer'", "SELECT check_name, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, CASE WHEN expected = actual THEN 'pass' ELSE 'fail' END AS status FROM (SELECT 'orders_with_customer'"
) + ")")
def quality_report(spark, d):
    o, c, li, p = (t(spark, d, x) for x in ("orders", "customer", "lineitem", "part"))
    parents = o.select(F.col("o_orderkey").alias("l_orderkey"))
    return quality.report(
        quality.same_count("orders_with_customer", o, o.join(c, o.o_custkey == c.c_custkey)),
        quality.unique_grain("lineitem_grain", li, ["l_orderkey", "l_linenumber"]),
        quality.no_orphans("lineitem_orphans", li, parents, ["l_orderkey"]),
        quality.same_sum("lines_sum", li, li.join(p, li.l_partkey == p.p_partkey), "l_linenumber"),
    )


@query("SELECT e.user_id, e.event_id, e.value FROM events e JOIN " + LATEST_SQL + " x ON e.user_id = x.user_id AND e.event_type = x.event_type AND e.ts <= x.ts")
def compat_latest_fact(spark, d):
    newest = _latest_events(spark, d).select("user_id", "event_type", F.col("ts").alias("newest"))
    return t(spark, d, "events").join(newest, ["user_id", "event_type"]).where("ts <= newest").select("user_id", "event_id", "value")


@query("""SELECT o_orderkey AS legacy_key, c_custkey AS company_key, n_name AS city FROM orders JOIN customer ON c_custkey = o_custkey
          LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON n_nationkey = c_nationkey WHERE c_acctbal > 0""")
def legacy_backfill_map(spark, d):
    o, c, n = t(spark, d, "orders"), t(spark, d, "customer").where("c_acctbal > 0"), t(spark, d, "nation").where("n_regionkey <> 0")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey, "left")
    return joined.select(F.col("o_orderkey").alias("legacy_key"), F.col("c_custkey").alias("company_key"), F.col("n_name").alias("city"))


@query("""SELECT event_id, sha256('["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]') AS digest FROM events""")
def observation_digest(spark, d):
    return t(spark, d, "events").select("event_id", tx.json_digest(F.col("event_type"), F.col("user_id").cast("string")).alias("digest"))


@query(r"""SELECT event_id, upper(sha256(CAST(regexp_replace(CAST(user_id AS VARCHAR) || '|' || event_type, '(.)', '\1\\x00', 'g') AS BLOB))) AS observation_id FROM events""")
def observation_identity(spark, d):
    return t(spark, d, "events").select("event_id", tx.observation_id(F.col("user_id").cast("string"), F.col("event_type")).alias("observation_id"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_props_extract(spark, d):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return t(spark, d, "events").select("event_type", k.alias("k")).groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT rule, count(*) AS violations FROM (
            SELECT 'value_range' AS rule FROM events WHERE value < 5 OR value > 95 UNION ALL SELECT 'status_known' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
            UNION ALL SELECT 'price_positive' FROM orders WHERE o_totalprice <= 2000) GROUP BY 1""")
def contract_violations(spark, d):
    e, o = t(spark, d, "events"), t(spark, d, "orders")
    bad = [("value_range", e.where("value < 5 OR value > 95")), ("status_known", o.where("o_orderstatus NOT IN ('F', 'O')")), ("price_positive", o.where("o_totalprice <= 2000"))]
    rows = [df.select(F.lit(name).alias("rule")) for name, df in bad]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
