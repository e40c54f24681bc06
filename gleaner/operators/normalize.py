"""From raw postings to normalised records: gate, fields, evidence, contract. Rejects are rows with a reason, not errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries, entities, rules
from ..functions import payload as pl
from ..functions.text import canonical_url, clean_text
from ..sources.html import readable_fields
from . import contract, gate

SOURCES = ("itviec", "topdev")
#: Fields that name a posting's role, and fields whose text tells its language, by source.
ROLE_FIELDS = {"itviec": ("title", "job_expertise", "job_domains"), "topdev": ("title", "job_types_str", "job_types_arr", "job_types")}
OTHER_ROLE_FIELDS = ("title", "job_roles", "roles", "job_expertise")
LANGUAGE_FIELDS = {
    "itviec": ("title", "job_description", "your_skills_and_experience", "why_youll_love_working_here", "top_reasons_to_join"),
    "topdev": ("title", "description", "descriptions", "responsibilities_original", "requirements_original", "requirements", "benefits_original", "benefits"),
}
OTHER_LANGUAGE_FIELDS = ("title", "description", "requirements")


def _texts_of(source: Column, v: Column, fields: dict[str, tuple[str, ...]], other: tuple[str, ...]) -> Column:
    """array<struct<field, text>>: the texts of the fields that count for a source."""
    held = lambda names: F.array(*[F.struct(F.lit(f).alias("field"), pl.at(v, f).alias("v")) for f in names])
    chosen = F.when(source == "itviec", held(fields["itviec"])).when(source == "topdev", held(fields["topdev"])).otherwise(held(other))
    return F.flatten(F.transform(chosen, lambda y: F.transform(pl.nested_texts(y["v"]), lambda x: F.struct(y["field"].alias("field"), x.alias("text")))))


def gated(postings: DataFrame, roles: dict[str, tuple[str, ...]] = dictionaries.ROLES) -> DataFrame:
    """postings (source, raw_payload, ...) with `payload` (variant), `language`, `matches` and `reason`."""
    rows = postings.withColumn("payload", pl.parsed("raw_payload"))
    v = F.col("payload")
    rows = rows.withColumn("_source", F.lower(F.trim(F.coalesce("source", pl.scalar(pl.at(v, "source")), F.lit("")))))
    rows = rows.withColumns(
        {
            "_roles": _texts_of(F.col("_source"), v, ROLE_FIELDS, OTHER_ROLE_FIELDS),
            "_texts": _texts_of(F.col("_source"), v, LANGUAGE_FIELDS, OTHER_LANGUAGE_FIELDS),
            "_stated": entities.stated_language(v),
        }
    )
    body = F.array_join(F.transform("_texts", lambda x: x["text"]), "\n")
    found = F.transform("_roles", lambda x: F.transform(gate.role_matches(x["text"], roles), lambda m: F.struct(m["role"].alias("role"), m["keyword"].alias("keyword"), x["field"].alias("field"))))
    rows = rows.withColumns({"language": F.coalesce("_stated", rules.posting_language(body)), "matches": F.array_distinct(F.flatten(found))})
    reason = (
        F.when(~pl.is_object(v), "invalid_raw_payload")
        .when(~F.exists("_roles", lambda x: gate.has_word(x["text"])), "missing_role_text")
        .when(F.col("language") == "other", "unsupported_language")
        .when(F.col("language") == "unknown", "unknown_language")
        .when(F.size("matches") > 0, gate.MATCHED)
        .otherwise("no_matching_role_keyword")
    )
    return rows.withColumn("reason", reason).drop("_source", "_roles", "_texts", "_stated")


def candidates(postings: DataFrame, roles: dict[str, tuple[str, ...]] = dictionaries.ROLES) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of gated postings."""
    decided = gated(postings, roles)
    return decided.where(F.col("reason") == gate.MATCHED), decided.where(F.col("reason") != gate.MATCHED)


def normalized(postings: DataFrame, roles: dict[str, tuple[str, ...]] = dictionaries.ROLES) -> DataFrame:
    """Every posting as a record of contract.BUSINESS_FIELDS with normalization_meta, and `reject_reason` (null for a record that keeps
    the contract). Input: job_id, crawl_run_id, source, source_job_id, job_url, observed_at (text), raw_payload (JSON)."""
    rows = gated(postings, roles).withColumn("_text", readable_fields("raw_payload"))
    v, text = F.col("payload"), F.col("_text")
    field = lambda *names: F.coalesce(*[clean_text(pl.scalar(pl.at(v, n))) for n in names])
    company = pl.at(v, "company")
    name = F.when(F.col("_source") == "itviec", clean_text(pl.scalar(pl.at(v, "company_name")))).otherwise(
        clean_text(F.when(pl.is_object(company), pl.first_true(pl.at(company, "display_name"), pl.at(company, "name"))).otherwise(pl.scalar(company)))
    )
    rows = rows.withColumn("_source", F.coalesce(clean_text("source"), field("source")))
    source = F.col("_source")
    # statements, languages' and experience's, are split once
    rows = rows.withColumn("_units", rules.statements(entities.requirements_text(text, source)))
    units = F.col("_units")
    rows = rows.withColumns(
        {
            "job_id": clean_text("job_id"),
            "crawl_run_id": clean_text("crawl_run_id"),
            "source_job_id": F.coalesce(clean_text("source_job_id"), field("source_job_id", "id")),
            "job_url": canonical_url(F.coalesce(clean_text("job_url"), field("url", "detail_url", "job_url"))),
            "observed_at": F.coalesce(pl.instant_of_text(F.col("observed_at")), pl.instant(pl.at(v, "crawled_at")), pl.instant(pl.at(v, "observed_at"))),
            "published_at": pl.instant(F.when(source == "itviec", pl.at(v, "date_posted")).otherwise(F.coalesce(pl.at(v, "published_at"), pl.at(v, "created_at"))), date_only=True),
            "title": field("title"),
            "company_name": name,
            "description": entities.description(text, source),
            "_experience": entities.experience(v, text, source, units),
            "_place": entities.locations(v, source),
            "_skills": entities.raw_skills(v, source),
            "_salary": entities.salary(v),
            "_declared": entities.declared_levels(v, source),
            "_explicit": F.when(source == "itviec", text["working_model"]).otherwise(text["job_types_str"]),
        }
    )
    e = F.col("_experience")
    by_years = F.when(e.isNotNull(), rules.experience_levels(e["low"], e["high"], e["relation"]))
    rows = rows.withColumn("_modes", rules.both_work_modes(F.col("_explicit"), F.col("description")))
    rows = rows.withColumns(
        {
            "_roles": entities.job_roles(F.col("matches"), F.col("title")),
            "_level": rules.seniority(F.col("_declared"), F.col("title"), by_years, ("source_explicit", "title", "general_experience")),
            "work_mode": rules.work_mode_of(F.col("_modes")),
            "skills": entities.skills(F.col("_skills")),
            "_languages": rules.languages_of(units, F.col("_skills")),
        }
    )
    s, money, years = F.col("_salary"), "decimal(18,2)", "decimal(10,4)"
    rows = rows.withColumns(
        {
            "job_roles": F.col("_roles.roles"),
            "seniority_levels": F.col("_level.levels"),
            "location_text": F.col("_place.location_text"),
            "cities": F.col("_place.cities"),
            "required_knowledge": entities.no_texts(),
            "experience_text": e["text"],
            "experience_min_years": e["low"].cast(years),
            "experience_max_years": e["high"].cast(years),
            "education_requirements": entities.education(text, source),
            "foreign_languages": F.transform("_languages", lambda x: F.struct(x["language"].alias("language"), x["level_text"].alias("level_text"))),
            "soft_skills": entities.no_texts(),
            "salary_text": s["text"],
            "salary_min": s["low"].cast(money),
            "salary_max": s["high"].cast(money),
            "salary_currency": s["currency"],
            "salary_period": s["period"],
            "salary_basis": s["basis"],
            "salary_status": s["status"],
            "normalization_meta": _meta(),
        }
    ).withColumn("source", source)
    required = F.greatest(*[F.col(c).isNull() for c in ("job_id", "crawl_run_id", "job_url", "observed_at", "title")])
    reject = (
        F.when(F.col("reason") != gate.MATCHED, F.col("reason"))
        .when(source.isNull() | ~source.isin(*SOURCES), "unsupported_source")
        .when(required, "missing_required_field")
        .when(F.col("description").isNull(), "missing_description")
        .otherwise(contract.first_violation(contract.BUSINESS_RULES))
    )
    return rows.withColumn("reject_reason", reject).select(*contract.BUSINESS_FIELDS, "normalization_meta", "reject_reason")


def _meta() -> Column:
    """struct<posting_language, fields, warnings>."""
    source, company = F.col("_source"), F.col("company_name")
    e, level, mode = F.col("_experience"), F.col("_level"), F.col("work_mode")
    high = lambda there: F.when(there, "high").otherwise("none")
    level_from = level["source"]
    level_evidence = F.when(level_from == "source_explicit", F.col("_declared")).when(level_from == "title", F.array("title")).when(level_from.isNotNull(), F.array(e["text"]))
    explicit = F.size("_modes.a") == 1
    mode_from = F.when(mode.isNull(), F.lit(None)).when(explicit, entities.by_source(source, F.lit("raw.working_model"), F.lit("raw.job_types_str"))).otherwise("description")
    languages = F.col("_languages")
    known = F.get(languages, 0)["language"] != "unknown"
    fields = {
        "title": entities.meta(F.lit("raw.title"), F.lit("high"), F.array("title")),
        "company_name": entities.meta(F.when(company.isNotNull(), entities.by_source(source, F.lit("raw.company_name"), F.lit("raw.company"))), high(company.isNotNull()), F.array(company)),
        "description": entities.meta(entities.description_source(F.col("_text"), source), F.lit("high"), F.array("description")),
        "job_roles": F.col("_roles.meta"),
        "seniority_levels": entities.meta(level_from, F.when(level_from == "general_experience", "medium").otherwise(high(level_from.isNotNull())), level_evidence, level["conflicts"]),
        "cities": F.col("_place.meta"),
        "work_mode": entities.meta(mode_from, F.when(mode_from == "description", "medium").otherwise(high(mode_from.isNotNull())), F.array(F.when(explicit, F.col("_explicit")).otherwise(mode)), rules.work_mode_conflicts_of(F.col("_modes"))),
        "skills": entities.skills_meta(F.col("_skills"), source),
        "experience_text": entities.meta(e["source"], high(e.isNotNull()), F.split(e["text"], "\n"), F.when(e["relation"] == "conflict", F.array(F.lit("incompatible experience bounds"))).otherwise(entities.no_texts())),
        "foreign_languages": entities.meta(F.when(known, F.lit("requirements+skills")), high(known), F.flatten(F.transform(languages, lambda x: x["evidence"]))),
    }
    warnings = F.array_compact(
        F.array(
            F.when(company.isNull(), F.lit("company_name is missing in source")),
            F.when(F.size(level["levels"]) == 0, F.lit("seniority_levels has no sufficiently clear evidence")),
            F.when(F.size("_place.cities") == 0, F.lit("cities has no recognized Vietnamese city/province")),
        )
    )
    return F.struct(F.col("language").alias("posting_language"), F.struct(*[c.alias(n) for n, c in fields.items()]).alias("fields"), warnings.alias("warnings"))


def persisted(records: DataFrame) -> DataFrame:
    """The records that keep the contract, in the columns that are stored: without experience, education, dates and salary, whose
    evidence leaves the meta data too."""
    # The row number keeps the optimizer from rebuilding every field inside the filter.
    stored = records.withColumn("_at", F.monotonically_increasing_id()).where("reject_reason IS NULL AND _at >= 0")
    level = F.col("normalization_meta.fields.seniority_levels")
    quiet = level.withField("evidence", F.when(level["source"] == "general_experience", entities.no_texts()).otherwise(level["evidence"]))
    fields = F.col("normalization_meta.fields").dropFields("experience_text").withField("seniority_levels", quiet)
    return stored.withColumn("normalization_meta", F.col("normalization_meta").withField("fields", fields)).select(*contract.PERSISTED_FIELDS)


def outcome_counts(records: DataFrame) -> DataFrame:
    """How many records each outcome has; `normalized` for those that keep the contract."""
    return records.groupBy(F.coalesce("reject_reason", F.lit("normalized")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
