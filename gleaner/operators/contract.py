"""Contracts: the fields of a layer, and rules that each row must keep. A rule that doesn't hold names itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of a normalised record, and those that are stored.
BUSINESS_FIELDS = (
    "job_id", "source", "source_job_id", "job_url", "crawl_run_id", "observed_at", "published_at", "title", "company_name", "description",
    "job_roles", "seniority_levels", "location_text", "cities", "work_mode", "skills", "required_knowledge", "experience_text",
    "experience_min_years", "experience_max_years", "education_requirements", "foreign_languages", "soft_skills", "salary_text",
    "salary_min", "salary_max", "salary_currency", "salary_period", "salary_basis", "salary_status",
)
NOT_STORED = (
    "experience_text", "experience_min_years", "experience_max_years", "education_requirements", "published_at", "required_knowledge",
    "salary_text", "salary_min", "salary_max", "salary_currency", "salary_period", "salary_basis", "salary_status",
)
PERSISTED_FIELDS = (*(f for f in BUSINESS_FIELDS if f not in NOT_STORED), "normalization_meta")
NORMALIZATION_VERSION, STORAGE_VERSION = "3.0", "5.1"


def _filled(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(F.trim(c) != "", F.lit(False)) for c in columns])


def _ordered(low: str, high: str) -> Column:
    return F.coalesce(F.col(low) <= F.col(high), F.lit(True))


def _nonnegative(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(c) >= 0, F.lit(True)) for c in columns])


#: Rules of a normalised record, in the order in which they are reported.
BUSINESS_RULES = {
    "required_text": lambda: _filled("job_id", "source", "job_url", "crawl_run_id", "title", "description", "salary_status"),
    "source": lambda: F.col("source").isin("itviec", "topdev"),
    "observed_at": lambda: F.col("observed_at").isNotNull(),
    "arrays": lambda: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("job_roles", "seniority_levels", "cities", "skills", "required_knowledge", "education_requirements", "foreign_languages", "soft_skills")]),
    "job_roles": lambda: F.size("job_roles") > 0,
    "work_mode": lambda: F.col("work_mode").isNull() | F.col("work_mode").isin("onsite", "hybrid", "remote"),
    "salary_status": lambda: F.col("salary_status").isin("disclosed", "negotiable", "not_disclosed", "unknown"),
    "numbers": lambda: _nonnegative("experience_min_years", "experience_max_years", "salary_min", "salary_max"),
    "experience_order": lambda: _ordered("experience_min_years", "experience_max_years"),
    "salary_order": lambda: _ordered("salary_min", "salary_max"),
    "disclosed_has_bounds": lambda: (F.col("salary_status") != "disclosed") | F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull(),
    "only_disclosed_has_bounds": lambda: (F.col("salary_status") == "disclosed") | (F.col("salary_min").isNull() & F.col("salary_max").isNull()),
}


def first_violation(rules: dict) -> Column:
    """The first rule that a row breaks; null if it keeps all. A rule that can't be decided is broken."""
    return F.coalesce(*[F.when(~F.coalesce(rule(), F.lit(False)), F.lit(name)) for name, rule in rules.items()])


def violations(rows: DataFrame, rules: dict, key: str) -> DataFrame:
    """(key, rule): a row for each rule that a row breaks."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule(), F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    return rows.select(key, F.explode(broken).alias("rule"))


def violation_counts(rows: DataFrame, rules: dict) -> DataFrame:
    """(rule, violations) of every rule, those that nothing breaks too; one pass."""
    counts = rows.agg(*[F.count(F.when(~F.coalesce(rule(), F.lit(False)), 1)).alias(name) for name, rule in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])).alias("x")).select("x.*")


class SchemaMismatch(ValueError):
    """A table's columns or types are not those of its contract."""


def expect_schema(df: DataFrame, ddl: str) -> DataFrame:
    """df itself, if its names and types are those of the DDL; nullability does not count."""
    want, got = T.StructType.fromDDL(ddl), df.schema
    pairs = [[(f.name, f.dataType.simpleString()) for f in s] for s in (want, got)]
    if pairs[0] != pairs[1]:
        raise SchemaMismatch(f"expected {want.simpleString()}, found {got.simpleString()}")
    return df


def writable(rows: DataFrame, stamp: str) -> DataFrame:
    """rows with write_error: the time stamp (a text) must have an offset, and floating numbers must be finite."""
    floats = [f.name for f in rows.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    bad = reduce(lambda a, b: a | b, [F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in floats], F.lit(False))
    offset = F.col(stamp).rlike(r"(Z|[+-]\d{2}:?\d{2})$") & F.col(stamp).try_cast("timestamp").isNotNull()
    return rows.withColumn("write_error", F.when(F.coalesce(bad, F.lit(False)), "not_a_json_number").when(~F.coalesce(offset, F.lit(False)), "time_without_offset"))
