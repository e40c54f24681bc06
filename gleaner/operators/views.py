"""Views over observations and their bridges: latest snapshot, demand, decoded facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import latest, star


def fact_job_latest(observed: DataFrame, *ties: str) -> DataFrame:
    """The newest observation of each job; later runs win ties, then the columns named in `ties`."""
    return latest.latest_by(observed, ["job_id"], "observed_at", "crawl_run_id", *ties)


def bridge_latest(observed: DataFrame, bridge: DataFrame, *ties: str) -> DataFrame:
    """The values of the newest observation of each job."""
    return bridge.join(fact_job_latest(observed, *ties).select("observation_key", "job_id"), "observation_key")


def demand_latest(observed: DataFrame, bridge: DataFrame, *ties: str) -> DataFrame:
    """(name, category, job_count, total_jobs, job_percent) over the newest observations."""
    newest = fact_job_latest(observed, *ties).select("observation_key", "job_id")
    total = newest.agg(F.count(F.lit(1)).alias("total_jobs"))  # one row
    found = bridge.join(newest, "observation_key").groupBy("name", "category").agg(F.countDistinct("job_id").alias("job_count"))
    return found.crossJoin(F.broadcast(total)).withColumn("job_percent", star.share(F.col("job_count"), F.col("total_jobs")))


def union_of_groups(bridges: dict[str, DataFrame]) -> DataFrame:
    """Bridges of several groups in one, with the group's name."""
    return reduce(DataFrame.unionByName, [b.withColumn("group", F.lit(g)) for g, b in bridges.items()])


def review_queue(observed: DataFrame, issues: DataFrame) -> DataFrame:
    """Open issues of the newest observations."""
    return issues.join(fact_job_latest(observed).select("observation_key", "job_id", "title"), "observation_key")


def decoded(facts: DataFrame, dims: dict[str, tuple[DataFrame, list[str]]], how: str = "inner") -> DataFrame:
    """Facts with the columns of their dimensions, joined on the (possibly composite) key of each."""
    return reduce(lambda df, x: df.join(x[0], x[1], how), dims.values(), facts)


def latest_facts(observed: DataFrame, facts: DataFrame, lineage: list[str]) -> DataFrame:
    """The facts of the newest observations."""
    return facts.join(fact_job_latest(observed).select(*lineage), lineage, "left_semi")


# -- semantic views of a star (see star_load.TABLES) ---------------------------------------------------------------
def newest_lineage(tables: dict[str, DataFrame]) -> DataFrame:
    """(job_key, crawl_run_key) of the newest observation of each job."""
    return latest.latest_by(tables["fact_job_observation"], ["job_key"], "observed_at_utc", "crawl_run_key").select("job_key", "crawl_run_key")


def semantic_job_observation(tables: dict[str, DataFrame], only_latest: bool = False) -> DataFrame:
    """Observations with the names of their job, source, company and run."""
    facts = tables["fact_job_observation"]
    facts = facts.join(newest_lineage(tables), ["job_key", "crawl_run_key"], "left_semi") if only_latest else facts
    dims = {"job": (tables["dim_job"].select("job_key", "job_id", "canonical_job_url"), ["job_key"]), "source": (tables["dim_source"].select("source_key", "source_name"), ["source_key"]),
            "company": (tables["dim_company"].select("company_key", "company_name"), ["company_key"]), "run": (tables["dim_crawl_run"].select("crawl_run_key", "crawl_run_id"), ["crawl_run_key"])}
    return decoded(facts, dims)


def semantic_job_skill(tables: dict[str, DataFrame], only_latest: bool = False) -> DataFrame:
    """Skill facts with job, skill and level: job_id, skill_type, skill_name, category, programming_language, level_name, context_no."""
    facts = tables["fact_job_necessary_skill"]
    facts = facts.join(newest_lineage(tables), ["job_key", "crawl_run_key"], "left_semi") if only_latest else facts
    levels = tables["dim_proficiency_level"].select("proficiency_level_key", "level_name")
    dims = {"job": (tables["dim_job"].select("job_key", "job_id"), ["job_key"]), "skill": (tables["dim_skill"].drop("normalized_name"), ["skill_key"]), "level": (levels, ["proficiency_level_key"])}
    return decoded(facts, dims)


def semantic_role_city(tables: dict[str, DataFrame], only_latest: bool = False) -> DataFrame:
    """Role-city facts with job, role and city."""
    facts = tables["fact_job_role_city"]
    facts = facts.join(newest_lineage(tables), ["job_key", "crawl_run_key"], "left_semi") if only_latest else facts
    dims = {"job": (tables["dim_job"].select("job_key", "job_id"), ["job_key"]), "role": (tables["dim_role"].drop("normalized_name"), ["role_key"]), "city": (tables["dim_city"].drop("normalized_name"), ["city_key"])}
    return decoded(facts, dims)


def point_lookup(df: DataFrame, **keys) -> DataFrame:
    """The rows with the given key."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]) == F.lit(kv[1])), keys.items(), df)


def scope(df: DataFrame, **values) -> DataFrame:
    """Rows of an optional scope: only the values that are given count."""
    return point_lookup(df, **{k: v for k, v in values.items() if v is not None})


def by_group(values: DataFrame, projections: dict) -> DataFrame:
    """Each group's rows in its own projection, side by side: projections maps a group to the Columns it derives."""
    return reduce(DataFrame.unionByName, [values.where(F.col("group") == g).select("*", *columns) for g, columns in projections.items()])


def sentence(title: str, company: str, day: str, amount: str):
    """'title at company on dd/MM/yyyy for $n,nnn.nn'."""
    return F.concat(F.col(title), F.lit(" at "), F.col(company), F.lit(" on "), F.date_format(day, "dd/MM/yyyy"), F.lit(" for $"), F.format_number(F.col(amount), 2))
