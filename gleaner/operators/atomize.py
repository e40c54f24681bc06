"""Atomization: multi-valued attributes become atoms of conformed groups; what can't be resolved becomes an issue."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionaries
from ..functions.normal_forms import exact_label_key, normal_text
from ..functions.text import fold, json_digest, label_key, lookup_map, packed_digest
from ..storage import stored
from . import contract

SEPARATORS = r"\s*[,;|/\n]\s*|\s+&\s+|\s+and\s+|\s+và\s+"


def lookup(names: dict[str, str]) -> Column:
    """Label key to canonical name, for a small dictionary."""
    return lookup_map(names)


def split_value(value: Column, known: Column) -> Column:
    """struct<atoms, issue>: a known label gives its canonical name; a composite whose parts are all known gives those; any
    other composite is an issue; a single unknown label is kept."""
    whole = known[label_key(value)]
    parts = F.filter(F.split(value, SEPARATORS), lambda p: F.trim(p) != "")
    named = F.transform(parts, lambda p: known[label_key(p)])
    none = F.array().cast("array<string>")
    made = lambda atoms, issue: F.struct(atoms.alias("atoms"), issue.cast("string").alias("issue"))
    return (
        F.when(F.coalesce(F.trim(value), F.lit("")) == "", made(none, F.lit(None)))
        .when(whole.isNotNull(), made(F.array(whole), F.lit(None)))
        .when(F.size(parts) <= 1, made(F.array(F.trim(value)), F.lit(None)))
        .when(F.forall(named, lambda x: x.isNotNull()), made(F.array_distinct(named), F.lit(None)))
        .otherwise(made(none, F.lit("unresolved_composite")))
    )


def atoms(rows: DataFrame, key: str, value: str, group: str, known: Column) -> DataFrame:
    """(key, group, name, atom_key), each atom once."""
    split = rows.select(key, split_value(F.col(value), known).alias("_s"))
    found = split.select(key, F.explode("_s.atoms").alias("name"))
    return found.select(key, F.lit(group).alias("group"), "name", json_digest(F.lit(group), label_key("name"), F.lit("")).alias("atom_key")).dropDuplicates([key, "atom_key"])


def atoms_of_table(rows: DataFrame, key: str, value: str, known: DataFrame, name: str) -> DataFrame:
    """(key, name): as atoms, for a vocabulary that is a table of any size: each part is looked up by a join."""
    names = known.select(label_key(name).alias("_k"), F.col(name).alias("_known")).dropDuplicates(["_k"])
    parts = rows.select(key, F.trim(value).alias("_value"), F.posexplode(F.array_append(F.split(value, SEPARATORS), F.col(value))).alias("_at", "_part"))
    parts = parts.where(F.trim("_part") != "").withColumn("_whole", label_key("_part") == label_key("_value")).withColumn("_k", label_key("_part"))
    found = parts.join(names, "_k", "left").groupBy(key, "_value").agg(
        F.max(F.when(F.col("_whole"), F.col("_known"))).alias("whole"),
        F.collect_set(F.when(~F.col("_whole"), F.col("_known"))).alias("named"),
        F.count(F.when(~F.col("_whole"), 1)).alias("n"),
        F.count(F.when(~F.col("_whole"), F.col("_known"))).alias("n_known"),
    )
    resolved = F.when(F.col("whole").isNotNull(), F.array("whole")).when(F.col("n") == 0, F.array("_value")).when(F.col("n") == F.col("n_known"), F.col("named"))
    return found.select(key, F.explode(resolved).alias("name")).distinct()


def issues(rows: DataFrame, key: str, value: str, field: str, known: Column) -> DataFrame:
    """(key, field_name, source_value, reason) of the values that need review."""
    split = rows.select(key, F.col(value).alias("source_value"), split_value(F.col(value), known).alias("_s"))
    return split.where("_s.issue IS NOT NULL").select(key, F.lit(field).alias("field_name"), "source_value", F.col("_s.issue").alias("reason"))


def canonical_skills(values: Column, aliases: dict[str, tuple[str, ...]]) -> Column:
    """Skill names with aliases expanded (one may stand for several), each once in order of appearance."""
    table = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))])
    return F.array_distinct(F.flatten(F.transform(values, lambda v: F.coalesce(table[label_key(v)], F.array(v)))))


def category(name: Column, groups: dict[str, tuple[str, ...]], default: str | Column = "other", key=label_key) -> Column:
    """The first group that lists a name."""
    out = F.lit(default)
    for group, names in reversed(groups.items()):
        out = F.when(key(name).isin(*names), F.lit(group)).otherwise(out)
    return out


def skill_category(name: Column) -> Column:
    """The category of a core skill, else the group of a skill."""
    return category(name, dictionaries.CORE_SKILLS, category(name, dictionaries.SKILL_GROUPS, key=fold))


# -- whole records -----------------------------------------------------------------------------------------------
#: Groups that a source's category of a skill stands for.
DECLARED_GROUPS = {
    "programming_language": "programming_language", "programming_languages": "programming_language",
    "framework_library": "framework", "frameworks_libraries": "framework", "framework": "framework",
}
#: What a record must be before it is atomized.
RECORD_RULES = {
    "version": lambda: F.col("normalization_version") == contract.STORAGE_VERSION,
    "required_text": lambda: F.concat_ws("", *[F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit("x")) for c in ("job_id", "source", "job_url", "crawl_run_id", "title", "description")]) == "",
    "identity": lambda: F.col("source").isin("itviec", "topdev") & F.startswith("job_id", F.concat("source", F.lit(":"))),
    "times": lambda: F.col("observed_at").isNotNull() & F.col("normalized_at").isNotNull(),
    "work_mode": lambda: F.col("work_mode").isNull() | F.col("work_mode").isin("onsite", "hybrid", "remote"),
    "roles": lambda: F.size("job_roles") > 0,
    "languages": lambda: F.size("foreign_languages") > 0,
}
#: The group of each list but skills, and the groups that a skill may be moved to, in the order of precedence.
LIST_GROUPS = {"job_roles": "role", "cities": "city", "seniority_levels": "level", "soft_skills": "soft_skill", "foreign_languages": "foreign_language"}
MOVES = ("foreign_language", "role", "soft_skill")
#: Categories of whole groups.
GROUP_CATEGORIES = {"programming_language": "programming_language", "framework": "framework_library"}

CATALOGUE_SCHEMA = "key string, lookup string, group string, name string, category string, identity string"


def observation_key() -> Column:
    return json_digest("job_id", "crawl_run_id")


def _pieces() -> Column:
    """array<struct<field, value, category, level>> of a record's lists; a null list has no entries."""
    none = F.lit(None).cast("string")
    made = lambda field, value, category=none, level=none: F.struct(F.lit(field).alias("field"), value.alias("value"), category.alias("category"), level.alias("level"))
    plain = [F.transform(f, _one(f, made)) for f in ("job_roles", "cities", "seniority_levels", "soft_skills")]
    skills = F.transform("skills", lambda x: made("skills", x["name"], x["category"]))
    languages = F.transform("foreign_languages", lambda x: made("foreign_languages", x["language"], none, x["level_text"]))
    return F.flatten(F.array_compact(F.array(*plain, skills, languages)))


def _one(field: str, made):
    return lambda x: made(field, x)


def _listed(records: DataFrame) -> DataFrame:
    """(observation_key, ps) of records that keep RECORD_RULES: all entries of their lists."""
    return records.where(contract.first_violation(RECORD_RULES).isNull()).select(observation_key().alias("observation_key"), _pieces().alias("ps"))


def _entries(listed: DataFrame) -> DataFrame:
    return listed.select("observation_key", F.explode("ps").alias("p")).where(F.coalesce(F.trim("p.value"), F.lit("")) != "")


def pieces(records: DataFrame) -> DataFrame:
    """(observation_key, p): one row for each entry of the lists of records that keep RECORD_RULES."""
    return _entries(_listed(records))


def catalogue_table(spark: SparkSession, catalogue: dict[str, list[tuple]] = dictionaries.CATALOGUE) -> DataFrame:
    """(key, hits): what every spelling stands for in each lookup."""
    rows = spark.createDataFrame(dictionaries.catalogue_rows(catalogue), CATALOGUE_SCHEMA)
    return rows.groupBy("key").agg(F.collect_list(F.struct("lookup", "group", "name", "category", "identity")).alias("hits"))


def _hit(part: Column, lookup: str | Column) -> Column:
    return F.get(F.filter(part["hits"], lambda h: h["lookup"] == lookup), 0)


def resolve(values: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(p, atoms, issues) of distinct list entries `p`. Each entry and each of its parts is looked up in the catalogue by a join; what an
    entry becomes is then settled from what its parts stand for.

    atoms: array<struct<group, value_key, name, category, context_key, level_text>>; issues: array<struct<field_name, source_value, reason>>."""
    text = lambda c: normal_text(F.col(c))
    rows = values.select("p", text("p.value").alias("text"), text("p.category").alias("category"), text("p.level").alias("level"))
    parts = rows.select("*", F.posexplode(F.array_prepend(F.split("text", SEPARATORS), F.col("text"))).alias("at", "part"))
    parts = parts.withColumn("part", F.trim("part")).withColumn("key", exact_label_key("part"))
    found = parts.join(catalogue, "key", "left").groupBy("p", "text", "category", "level").agg(F.sort_array(F.collect_list(F.struct("at", "key", "hits"))).alias("parts"))

    field, whole = F.col("p.field"), F.col("parts")[0]
    skill = field == "skills"
    of_list = lookup_map(LIST_GROUPS)[field]
    found = found.withColumns(
        {
            "lookup": F.when(skill, "skill").otherwise(of_list),
            "rest": F.slice("parts", 2, F.size("parts")),
            "moved": F.when(skill, F.coalesce(*[_hit(whole, g) for g in MOVES])),
            "declared": F.when(skill, F.coalesce(lookup_map(DECLARED_GROUPS)[F.col("category")], F.lit("core_skill"))).otherwise(of_list),
        }
    )
    domain = skill & F.col("moved").isNull() & _hit(whole, "business_domain").isNotNull()
    sentinel = (field == "foreign_languages") & (whole["key"] == "unknown")
    named = F.transform("rest", lambda x: _hit(x, F.col("lookup")))
    found = found.withColumns({"domain": domain, "sentinel": sentinel, "known": _hit(whole, F.col("lookup")), "named": named})
    unknown = F.struct(F.col("lookup"), F.col("declared").alias("group"), F.col("text").alias("name"), F.lit(None).cast("string").alias("category"), F.col("text").alias("identity"))
    whole_known, several = F.col("known").isNotNull(), F.size("rest") > 1
    all_known = F.forall("named", lambda x: x.isNotNull())
    none = F.array().cast("array<struct<lookup:string,group:string,name:string,category:string,identity:string>>")
    chosen = (
        F.when(F.col("moved").isNotNull(), F.array("moved"))
        .when(F.col("domain") | F.col("sentinel"), none)
        .when(whole_known, F.array("known"))
        .when(~several, F.array(unknown))
        .when(all_known, F.col("named"))
        .otherwise(none)
    )
    unresolved = F.col("moved").isNull() & ~F.col("domain") & ~F.col("sentinel") & ~whole_known & several & ~all_known
    found = found.withColumns({"chosen": chosen, "unresolved": unresolved})

    language = lambda a: a["group"] == "foreign_language"
    level_digest = F.sha2(F.when(F.col("level").isNull(), "null").otherwise(F.regexp_replace(F.to_json(F.array("level")), r"^\[|\]$", "")), 256)
    own_category = F.when(skill & F.col("moved").isNull(), F.col("category"))
    category = lambda a: F.coalesce(a["category"], lookup_map(GROUP_CATEGORIES)[a["group"]], own_category, F.lit(""))
    atom = lambda a: F.struct(
        a["group"].alias("group"),
        json_digest(a["group"], a["identity"], category(a)).alias("value_key"),
        a["name"].alias("name"),
        category(a).alias("category"),
        F.when(language(a), level_digest).otherwise(F.lit("")).alias("context_key"),
        F.when(language(a) & (field == "foreign_languages"), F.col("level")).alias("level_text"),
    )
    review = skill & F.col("moved").isNull() & F.col("category").isin("other", "domain") & F.exists("chosen", lambda a: a["group"] == "core_skill")
    issue = lambda where, name, reason: F.when(where, F.struct(name.alias("field_name"), F.col("text").alias("source_value"), reason.alias("reason")))
    issues = F.array_compact(
        F.array(
            issue(F.col("moved").isNotNull(), field, F.concat(F.col("moved.group"), F.lit("_tag_moved"))),
            issue(F.col("domain"), field, F.lit("business_domain_not_a_skill")),
            issue(F.col("unresolved"), F.col("declared"), F.lit("unresolved_composite")),
            issue(F.col("sentinel"), field, F.lit("source_did_not_specify_language")),
            issue(review, field, F.lit("category_needs_review")),
        )
    )
    return found.select("p", F.transform("chosen", atom).alias("atoms"), issues.alias("issues"))


def _joined(records: DataFrame, catalogue: dict[str, list[tuple]]) -> DataFrame:
    """(observation_key, atoms, issues) of every list entry. Records are dealt out by observation before their entries are many rows with
    long keys, so that what is done for each observation afterwards needs no shuffle of those."""
    resolved = stored(resolve(pieces(records).select("p").distinct(), catalogue_table(records.sparkSession, catalogue)), "atoms-resolved")
    listed = _entries(_listed(records).repartition("observation_key"))
    return listed.join(resolved, "p").select("observation_key", "atoms", "issues")


def atomize_records(records: DataFrame, catalogue: dict[str, list[tuple]] = dictionaries.CATALOGUE) -> tuple[DataFrame, DataFrame]:
    """(values, issues) of records that keep RECORD_RULES.

    values: observation_key, group, value_key, name, category, context_key, level_text, each (group, value_key, context_key) once in an
    observation. Skills that name a language, role or soft skill are moved, business domains dropped, unresolved composites reported.

    Entries repeat far more often than they differ, so each distinct one is resolved once and written; the table of the resolved
    entries then joins the records, broadcast only if its stored size is small. Null and blank entries are left out."""
    joined = _joined(records, catalogue)
    values = joined.select("observation_key", F.inline("atoms")).dropDuplicates(["observation_key", "group", "value_key", "context_key"])
    found = joined.select("observation_key", F.inline("issues")).withColumn("issue_key", json_digest("field_name", "source_value", "reason"))
    return values, found.dropDuplicates(["observation_key", "issue_key"])


def observations(records: DataFrame, values: DataFrame) -> DataFrame:
    """The scalar row of each atomized record, with foreign_language_status."""
    own = lambda key: packed_digest(key).alias("_own")
    spoken = values.where(F.col("group") == "foreign_language").select(own("observation_key")).distinct().withColumn("_spoken", F.lit(True))
    rows = records.where(contract.first_violation(RECORD_RULES).isNull()).select(own(observation_key()), *SCALARS).join(spoken, "_own", "left")
    return rows.select(F.lower(F.hex("_own")).alias("observation_key"), *SCALARS, F.when(F.col("_spoken"), "known").otherwise("unknown").alias("foreign_language_status"))


SCALARS = ("job_id", "source", "source_job_id", "job_url", "crawl_run_id", "observed_at", "title", "company_name", "description", "location_text", "work_mode")


def outputs(records: DataFrame, catalogue: dict[str, list[tuple]] = dictionaries.CATALOGUE) -> DataFrame:
    """One row for each record that keeps RECORD_RULES: its scalars, foreign_language_status, its sorted `atoms` and `issues`, and the
    digests of the record and of the catalogue it was made with. With a guarded table this is all that belongs to an observation at
    once; values_of and issues_of are its bridges."""
    sound = records.where(contract.first_violation(RECORD_RULES).isNull()).withColumn("observation_key", observation_key())
    record = F.struct(*[F.unix_micros(F.col(c).cast("timestamp")).alias(c) if c in ("observed_at", "normalized_at") else F.col(c) for c in sorted(records.columns)])
    once = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    made = _joined(records, catalogue).groupBy("observation_key").agg(once("atoms").alias("atoms"), once("issues").alias("issues"))
    model = hashlib.sha256(json.dumps(catalogue, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    spoken = F.exists("atoms", lambda a: a["group"] == "foreign_language")
    rows = sound.select(
        "observation_key", *SCALARS, F.col("normalized_at").alias("source_normalized_at"), F.col("normalization_version").alias("source_normalization_version"), F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256).alias("source_sha256")
    )
    return rows.join(made, "observation_key", "left").withColumns({"foreign_language_status": F.when(spoken, "known").otherwise("unknown"), "model_sha256": F.lit(model)})


def values_of(found: DataFrame) -> DataFrame:
    """The values of outputs, as atomize_records gives them."""
    return found.select("observation_key", F.inline("atoms"))


def issues_of(found: DataFrame) -> DataFrame:
    """The issues of outputs, with their keys."""
    return found.select("observation_key", F.inline("issues")).withColumn("issue_key", json_digest("field_name", "source_value", "reason"))


# -- natural keys of the star ------------------------------------------------------------------------------------
def _by_name(groups: dict[str, tuple[str, ...]]) -> Column:
    """The group that lists a name, by label key."""
    return lookup_map({dictionaries.spelling_key(name): group for group, names in groups.items() for name in names})


def core_skill_category(name: Column, declared: Column) -> Column:
    """The category that lists a core skill, else the declared one."""
    return F.coalesce(_by_name(dictionaries.CORE_SKILLS)[label_key(name)], declared)


def framework_language(name: Column) -> Column:
    """The programming language of a framework; null for patterns and unknown names."""
    return _by_name(dictionaries.FRAMEWORK_LANGUAGES)[label_key(name)]


def role_category(name: Column) -> Column:
    """The category that lists a role, else the default."""
    return F.coalesce(_by_name(dictionaries.ROLE_CATEGORIES)[label_key(name)], F.lit(dictionaries.DEFAULT_ROLE_CATEGORY))
