"""Loading atomized observations into the star: conformed dimensions by natural key, append-only facts by grain.

A load is a function of the stored tables and the new observations; its result is the next snapshot of every table, to be
published (operators.publish). Surrogate keys are hashes of natural keys, so no table has to be read to give one out, and a
load that is run again adds nothing. Stored members keep their display values; a job's first and last sight move with
what is seen, in whatever order it arrives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import dictionaries
from ..functions.text import lookup_map, natural_key, observation_id, packed_digest
from . import atomize, quality
from .latest import context_numbers
from .star import UNKNOWN_KEY, stable_key

NECESSARY = ("core_skill", "foreign_language", "framework", "programming_language")
PIPELINE_VERSION = "5.1"

#: Every table: its columns, its key, and the natural key or grain.
TABLES = {
    "dim_date": ("date_key int, calendar_date date, day_of_week int, day_name string, month_no int, month_name string, quarter_no int, year_no int, is_weekend boolean", ["date_key"]),
    "dim_source": ("source_key long, source_code string, source_name string, is_active boolean", ["source_code"]),
    "dim_company": ("company_key long, company_name string, normalized_name string", ["normalized_name"]),
    "dim_crawl_run": ("crawl_run_key long, crawl_run_id string, source_scope string, pipeline_version string, started_at_utc timestamp, finished_at_utc timestamp, run_status string", ["crawl_run_id"]),
    "dim_job": ("job_key long, job_id string, source_job_id string, canonical_job_url string, first_seen_at_utc timestamp, last_seen_at_utc timestamp", ["job_id"]),
    "dim_skill": ("skill_key long, skill_type string, skill_name string, normalized_name string, category string, programming_language string", ["skill_type", "normalized_name", "category"]),
    "dim_role": ("role_key long, role_name string, normalized_name string, role_category string", ["normalized_name", "role_category"]),
    "dim_city": ("city_key long, city_name string, normalized_name string", ["normalized_name"]),
    "dim_proficiency_level": ("proficiency_level_key long, level_name string, normalized_name string", ["normalized_name"]),
    "fact_job_observation": ("observation_id string, job_key long, date_key int, source_key long, company_key long, crawl_run_key long, observed_at_utc timestamp, job_title_snapshot string, work_mode string, job_posting_count int", ["job_key", "crawl_run_key"]),
    "fact_job_necessary_skill": ("observation_id string, job_key long, date_key int, source_key long, crawl_run_key long, skill_key long, proficiency_level_key long, context_no int, level_text_snapshot string, skill_mention_count int", ["job_key", "crawl_run_key", "skill_key", "context_no"]),
    "fact_job_role_city": ("observation_id string, job_key long, date_key int, source_key long, crawl_run_key long, role_key long, city_key long, combination_count int", ["job_key", "crawl_run_key", "role_key", "city_key"]),
}
#: Dimensions with an unknown member, and its natural key.
UNKNOWN = {"dim_company": "unknown", "dim_role": "unknown", "dim_city": "unknown", "dim_proficiency_level": "unknown"}


def bootstrap(spark) -> dict[str, DataFrame]:
    """Every table with its columns, empty but for the unknown members. The empty ones are known to be so when a query is planned, and
    what would be joined with them is not shuffled."""
    found = {}
    for name, (ddl, natural) in TABLES.items():
        df = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)]).where(F.lit(False))
        if name in UNKNOWN:
            key = ddl.split()[0]
            row = [F.lit(UNKNOWN_KEY).cast("long").alias(f.name) if f.name == key else F.lit("unknown" if f.name in natural else "Unknown").cast(f.dataType).alias(f.name) for f in df.schema]
            df = df.unionByName(spark.range(1).select(*row))
        found[name] = df
    return found


def date_row(day: Column) -> list[Column]:
    """The columns of dim_date of a day."""
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day.alias("calendar_date"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month_no"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_no"),
        F.year(day).alias("year_no"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]


def source_name(code: Column) -> Column:
    return F.coalesce(lookup_map(dictionaries.SOURCE_NAMES)[code], code)


def skill_rows(values: DataFrame) -> DataFrame:
    """observation_key, the natural key and the other columns of dim_skill, level_text; languages have no category."""
    group, declared = F.col("group"), F.coalesce("category", F.lit(""))
    category = F.when(group == "core_skill", atomize.core_skill_category(F.col("name"), declared)).when(group == "foreign_language", "").otherwise(declared)
    language = F.when(group == "framework", atomize.framework_language(F.col("name")))
    return values.where(group.isin(*NECESSARY, "soft_skill")).select(
        "observation_key", group.alias("skill_type"), F.col("name").alias("skill_name"), natural_key("name").alias("normalized_name"), category.alias("category"), language.alias("programming_language"), "level_text"
    )


def role_rows(values: DataFrame) -> DataFrame:
    return values.where(F.col("group") == "role").select("observation_key", F.col("name").alias("role_name"), natural_key("name").alias("normalized_name"), atomize.role_category(F.col("name")).alias("role_category"))


def _members(rows: DataFrame, natural: list[str], key: str) -> DataFrame:
    """A member for each natural key; the smallest display values stand for it."""
    shown = [c for c in rows.columns if c not in natural]
    return rows.dropna(subset=natural).groupBy(*natural).agg(*[F.min(c).alias(c) for c in shown]).withColumn(key, stable_key(*natural))


def new_dimensions(observed: DataFrame, values: DataFrame) -> dict[str, DataFrame]:
    """The members that some observations need."""
    skills, roles = skill_rows(values).drop("observation_key"), role_rows(values).drop("observation_key")
    cities = values.where(F.col("group") == "city").select(F.col("name").alias("city_name"), natural_key("name").alias("normalized_name"))
    levels = skills.where("skill_type = 'foreign_language' AND level_text IS NOT NULL").select(F.col("level_text").alias("level_name"), natural_key("level_text").alias("normalized_name"))
    companies = observed.where(F.trim("company_name") != "").select(F.trim("company_name").alias("company_name"), natural_key("company_name").alias("normalized_name"))
    one_source = F.when(F.countDistinct("source") == 1, F.min("source")).otherwise("multi")
    runs = observed.groupBy("crawl_run_id").agg(one_source.alias("source_scope"), F.min("observed_at").alias("started_at_utc"), F.max("observed_at").alias("finished_at_utc"))
    newest = F.max(F.struct("observed_at", "crawl_run_id", "source_job_id", "job_url"))
    jobs = observed.groupBy("job_id").agg(newest.alias("x"), F.min("observed_at").alias("first_seen_at_utc"), F.max("observed_at").alias("last_seen_at_utc"))
    return {
        "dim_date": observed.select(F.to_date("observed_at").alias("day")).distinct().select(*date_row(F.col("day"))),
        "dim_source": observed.select(F.col("source").alias("source_code")).distinct().select(stable_key("source_code").alias("source_key"), "source_code", source_name(F.col("source_code")).alias("source_name"), F.lit(True).alias("is_active")),
        "dim_company": _members(companies, ["normalized_name"], "company_key"),
        "dim_crawl_run": runs.withColumns({"crawl_run_key": stable_key("crawl_run_id"), "pipeline_version": F.lit(PIPELINE_VERSION), "run_status": F.lit("succeeded")}),
        "dim_job": jobs.select(stable_key("job_id").alias("job_key"), "job_id", "x.source_job_id", F.col("x.job_url").alias("canonical_job_url"), "first_seen_at_utc", "last_seen_at_utc"),
        "dim_skill": _members(skills.drop("level_text"), ["skill_type", "normalized_name", "category"], "skill_key"),
        "dim_role": _members(roles, ["normalized_name", "role_category"], "role_key"),
        "dim_city": _members(cities, ["normalized_name"], "city_key"),
        "dim_proficiency_level": _members(levels, ["normalized_name"], "proficiency_level_key"),
    }


def new_facts(observed: DataFrame, values: DataFrame) -> dict[str, DataFrame]:
    """The fact rows of some observations. What belongs to an observation is dealt out once, by its key; digests travel as bytes."""
    company = F.when(F.coalesce(F.trim("company_name"), F.lit("")) != "", stable_key(natural_key("company_name"))).otherwise(F.lit(UNKNOWN_KEY).cast("long"))
    base = observed.select(
        "observation_key",
        observation_id("job_id", "crawl_run_id").alias("observation_id"),
        stable_key("job_id").alias("job_key"),
        F.date_format("observed_at", "yyyyMMdd").cast("int").alias("date_key"),
        stable_key("source").alias("source_key"),
        company.alias("company_key"),
        stable_key("crawl_run_id").alias("crawl_run_key"),
        F.col("observed_at").alias("observed_at_utc"),
        F.col("title").alias("job_title_snapshot"),
        "work_mode",
        F.lit(1).alias("job_posting_count"),
    )
    own, names = packed_digest("observation_key").alias("_own"), ["job_key", "date_key", "source_key", "crawl_run_key"]
    child = base.select(own, F.unhex("observation_id").alias("_id"), *names)
    told = [F.hex("_id").alias("observation_id"), *names]
    skills = skill_rows(values).where(F.col("skill_type").isin(*NECESSARY)).select(own, stable_key("skill_type", "normalized_name", "category").alias("skill_key"), "level_text")
    skills = context_numbers(skills.repartition("_own"), ["_own", "skill_key"], "level_text")
    level = F.when(F.col("level_text").isNotNull(), stable_key(natural_key("level_text"))).otherwise(F.lit(UNKNOWN_KEY).cast("long"))
    skills = child.join(skills, "_own").select(*told, "skill_key", level.alias("proficiency_level_key"), "context_no", F.col("level_text").alias("level_text_snapshot"), F.lit(1).alias("skill_mention_count"))
    roles = role_rows(values).select(own, stable_key("normalized_name", "role_category").alias("role_key")).repartition("_own").distinct()
    cities = values.where(F.col("group") == "city").select(own, stable_key(natural_key("name")).alias("city_key")).repartition("_own").distinct()
    unknown = lambda c: F.coalesce(c, F.lit(UNKNOWN_KEY).cast("long")).alias(c)
    placed = child.join(roles, "_own", "left").join(cities, "_own", "left").select(*told, unknown("role_key"), unknown("city_key"), F.lit(1).alias("combination_count"))
    return {"fact_job_observation": base.drop("observation_key"), "fact_job_necessary_skill": skills, "fact_job_role_city": placed}


def merged_jobs(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Jobs with the widest span of sights, and the address of the newest."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    newest = F.max(F.struct("last_seen_at_utc", "_new", "source_job_id", "canonical_job_url"))
    merged = both.groupBy("job_key", "job_id").agg(newest.alias("x"), F.min("first_seen_at_utc").alias("first_seen_at_utc"), F.max("last_seen_at_utc").alias("last_seen_at_utc"))
    return merged.select("job_key", "job_id", "x.source_job_id", "x.canonical_job_url", "first_seen_at_utc", "last_seen_at_utc")


def repaired(facts: DataFrame, lineage: DataFrame) -> DataFrame:
    """Facts with the observation_id that their job and run give."""
    right = lineage.select("job_key", "crawl_run_key", F.col("observation_id").alias("_id"))
    return facts.join(right, ["job_key", "crawl_run_key"], "left").withColumn("observation_id", F.coalesce("_id", "observation_id")).select(*facts.columns)


def exact(facts: DataFrame, wanted: DataFrame, lineage: DataFrame, grain: list[str], carried: list[str]) -> DataFrame:
    """The facts after a load that retracts: for the observations of `lineage` exactly the wanted ones, with its observation_id; those of
    other observations stay. A stored row that says the same as a wanted one stays, a wanted one whose grain is then taken doesn't come in.

    Everything that decides about a row belongs to its observation, so all meets in one shuffle by job and run; wanted rows travel without
    the observation_id, which their lineage has, and the others with its bytes where it is a digest."""
    names, kind = facts.columns, F.col("_kind")
    rest, digest = [c for c in names if c != "observation_id"], F.col("observation_id").rlike("^[0-9A-F]{64}$")
    ids = [F.when(digest, F.unhex("observation_id")).alias("_bytes"), F.when(~digest, F.col("observation_id")).alias("_text")]
    told = lineage.select("job_key", "crawl_run_key", *ids, F.lit("lineage").alias("_kind"))
    given = wanted.select(*rest, F.lit("wanted").alias("_kind"))
    both = facts.select(*rest, *ids, F.lit("stored").alias("_kind")).unionByName(given, allowMissingColumns=True).unionByName(told, allowMissingColumns=True)
    within = lambda *keys: Window.partitionBy("job_key", "crawl_run_key", *[k for k in keys if k not in ("job_key", "crawl_run_key")])
    met = both.repartition("job_key", "crawl_run_key").withColumn("observation_id", F.coalesce(F.hex("_bytes"), "_text"))
    met = met.withColumn("_id", F.max(F.when(kind == "lineage", F.col("observation_id"))).over(within())).where(kind != "lineage")
    met = met.withColumn("_said", F.max(kind == "wanted").over(within(*grain, *carried)))
    met = met.withColumn("_stays", (kind == "stored") & (F.col("_id").isNull() | F.col("_said"))).withColumn("_taken", F.max("_stays").over(within(*grain)))
    return met.where(F.col("_stays") | ((kind == "wanted") & ~F.col("_taken"))).withColumn("observation_id", F.coalesce("_id", "observation_id")).select(*names)


#: What a fact of a grain says: a row that says something else is taken out and put in anew.
CARRIED = {"fact_job_necessary_skill": ["level_text_snapshot", "proficiency_level_key"], "fact_job_role_city": []}


def load(stored: dict[str, DataFrame], observed: DataFrame, values: DataFrame, retract: bool = False) -> dict[str, DataFrame]:
    """The next snapshot of every table. With `retract`, skill and role-city facts of the loaded observations become exactly the set that
    their values give; without it, facts are only added."""
    new = new_dimensions(observed, values) | new_facts(observed, values)
    out = {}
    for name, (_, grain) in TABLES.items():
        columns = stored[name].columns
        if name == "dim_job":
            out[name] = merged_jobs(stored[name], new[name].select(*columns))
            continue
        if retract and name in CARRIED and not stored[name].isEmpty():
            out[name] = exact(stored[name], new[name], new["fact_job_observation"], grain, CARRIED[name])
            continue
        kept = repaired(stored[name], new["fact_job_observation"]) if name.startswith("fact") else stored[name]
        out[name] = kept.unionByName(new[name].select(*columns).join(kept.select(*grain), grain, "left_anti"))
    return out


def fact_changes(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """(table, action, n): facts inserted and deleted between two snapshots; none if a load changes nothing."""
    lines = []
    for name in CARRIED:
        columns = [c for c in before[name].columns if c != "observation_id"]
        both = before[name].select(*columns, F.lit(-1).alias("_n")).unionByName(after[name].select(*columns, F.lit(1).alias("_n")))
        # one shuffle, by observation, finds what is too many on either side; equal rows differ by their number
        differs = both.repartition("job_key", "crawl_run_key").groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
        found = differs.groupBy(F.when(F.col("_n") > 0, "insert").otherwise("delete").alias("action")).agg(F.sum(F.abs("_n")).alias("n"))
        lines.append(found.select(F.lit(name).alias("table"), "action", "n"))
    return reduce(DataFrame.unionByName, lines)


def added(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """(table, rows_added) of a load; rows whose observation_id is repaired don't count."""
    size = lambda name, df, sign: df.agg((F.lit(sign) * F.count(F.lit(1))).alias("n")).select(F.lit(name).alias("table"), "n")
    lines = [size(name, tables[name], sign) for name in TABLES for tables, sign in ((before, -1), (after, 1))]
    return reduce(DataFrame.unionByName, lines).groupBy("table").agg(F.sum("n").alias("rows_added"))


def gates(read) -> DataFrame:
    """What a snapshot must satisfy: unique grains, complete lineage on five keys, known members, and no more facts than combinations."""
    facts = read("fact_job_observation")
    lineage = ["observation_id", "job_key", "date_key", "source_key", "crawl_run_key"]
    checks = [quality.unique_grain(f"grain_{name}", read(name), grain) for name, (_, grain) in TABLES.items()]
    for child in ("fact_job_necessary_skill", "fact_job_role_city"):
        checks.append(quality.no_orphans(f"lineage_{child}", read(child), facts, lineage))
    for child, dim, key in (("fact_job_necessary_skill", "dim_skill", "skill_key"), ("fact_job_role_city", "dim_role", "role_key"), ("fact_job_role_city", "dim_city", "city_key"), ("fact_job_observation", "dim_company", "company_key"), ("fact_job_observation", "dim_date", "date_key")):
        checks.append(quality.mapping_complete(f"mapped_{child}_{key}", read(child), read(dim), [key]))
    checks.append(quality.at_least("history_covers_jobs", facts, read("dim_job")))
    return quality.report(*checks)
