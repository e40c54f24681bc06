"""Entities of a posting, from the variant of its payload and the readable text of its fields: places, skills, roles,
languages, experience, salary. Each is a Column expression; the parts of the payload differ by source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dictionaries, rules
from . import payload as pl
from .text import clean_items, clean_once, clean_text, distinct_ignoring_case, fold, fold_plain, let, lookup_map, short_items

def no_texts() -> Column:
    return F.array().cast("array<string>")


def by_source(source: Column, itviec: Column, other: Column) -> Column:
    return F.when(source == "itviec", itviec).otherwise(other)


def meta(source: Column, confidence: Column, evidence: Column, conflicts: Column | None = None) -> Column:
    """struct<source, confidence, evidence, conflicts>: where a value comes from and what speaks for and against it."""
    return F.struct(
        source.cast("string").alias("source"),
        confidence.alias("confidence"),
        short_items(F.coalesce(evidence, no_texts())).alias("evidence"),
        (short_items(conflicts) if conflicts is not None else no_texts()).alias("conflicts"),
    )


# -- places ------------------------------------------------------------------------------------------------------
def cities(values: Column) -> Column:
    """Places named in some texts, in order of appearance, each once."""
    return F.array_distinct(F.flatten(F.transform(values, lambda x: rules.places_in(x, dictionaries.PLACES))))


def _flat(items: Column, read) -> Column:
    return F.flatten(F.transform(items, read))


def addresses(v: Column, source: Column) -> Column:
    """Full addresses of a payload, in order."""
    item = lambda x: F.when(pl.is_object(x), pl.texts(pl.at(x, "address"))).otherwise(pl.texts(x))
    streets = _flat(pl.members(pl.at(v, "locations_structured")), lambda x: pl.texts(pl.at(x, "address", "streetAddress")))
    own = pl.at(v, "addresses")
    other = lambda x: F.when(pl.is_object(x), pl.texts(F.coalesce(pl.at(x, "full_address"), pl.at(x, "address")))).otherwise(pl.texts(x))
    listed = F.when(pl.is_object(own), pl.texts(pl.at(own, "full_addresses"))).otherwise(_flat(pl.members(own), other))
    return by_source(source, F.concat(_flat(pl.members(own), item), streets), listed)


def regions(v: Column, source: Column) -> Column:
    """Structured provinces of a payload."""
    region = lambda x: pl.texts(F.coalesce(pl.at(x, "address", "addressRegion"), pl.at(x, "address", "addressLocality")))
    own = pl.at(v, "addresses")
    other = lambda x: F.when(pl.is_object(x), pl.texts(F.coalesce(pl.at(x, "city"), pl.at(x, "province")))).otherwise(no_texts())
    listed = F.when(pl.is_object(own), pl.texts(pl.at(own, "address_region_array"))).otherwise(_flat(pl.members(own), other))
    return by_source(source, _flat(pl.members(pl.at(v, "locations_structured")), region), listed)


#: Where cities may come from, the most trusted first.
CITY_SOURCES = ("structured_address", "source_city", "full_address", "location_text", "title")


def locations(v: Column, source: Column) -> Column:
    """struct<location_text, cities, meta>."""
    parts = F.struct(
        addresses(v, source).alias("full"),
        regions(v, source).alias("regions"),
        by_source(source, pl.texts(pl.at(v, "city_on_listing")), no_texts()).alias("listed"),
        pl.texts(pl.at(v, "location_text")).alias("text"),
        pl.texts(pl.at(v, "title")).alias("title"),
        F.coalesce(clean_text(pl.scalar(pl.at(v, "location_text"))), clean_text(pl.scalar(pl.at(v, "city_on_listing")))).alias("plain"),
    )

    def placed(p: Column) -> Column:
        found = [("structured_address", p["regions"]), ("source_city", p["listed"]), ("full_address", p["full"]), ("location_text", p["text"]), ("title", p["title"])]
        candidates = F.array(*[F.struct(F.lit(n).alias("name"), cities(x).alias("cities")) for n, x in found])
        return let(candidates, lambda c: _chosen_place(c, p))

    return let(parts, placed)


def _chosen_place(candidates: Column, p: Column) -> Column:
    return let(F.filter(candidates, lambda c: F.size(c["cities"]) > 0), lambda known: let(F.get(known, 0), lambda pick: _place(known, pick, p)))


def _place(known: Column, pick: Column, p: Column) -> Column:
    name, found = pick["name"], F.coalesce(pick["cities"], no_texts())
    differs = F.filter(known, lambda c: (c["name"] != name) & (F.sort_array(c["cities"]) != F.sort_array(found)))
    told = lambda some: F.transform(some, lambda c: F.concat(c["name"], F.lit(": "), F.array_join(c["cities"], ", ")))
    conflicts = F.concat(told(F.filter(differs, lambda c: c["name"] == "title")), told(F.filter(differs, lambda c: c["name"] != "title")))
    text = F.coalesce(F.nullif(F.array_join(distinct_ignoring_case(p["full"]), "\n"), F.lit("")), p["plain"], F.nullif(F.array_join(found, ", "), F.lit("")))
    confidence = F.when(name.isin("structured_address", "source_city"), "high").when(name == "full_address", "medium").when(name.isNotNull(), "low").otherwise("none")
    return F.struct(text.alias("location_text"), found.alias("cities"), meta(name, confidence, found, conflicts).alias("meta"))


# -- skills ------------------------------------------------------------------------------------------------------
#: Names of languages that sources list among skills, and wordings around them, on folded text.
LANGUAGE_SKILLS = ("english", "tieng anh", "korean", "tieng han", "japanese", "tieng nhat", "chinese", "tieng trung")
LANGUAGE_SKILL_WORDINGS = (
    r"(?:english|tieng anh)(?: (?:communication|communicative|proficiency|language|skills?|[abc][12]))",
    r"(?:japanese|tieng nhat)(?: (?:communication|proficiency|language|skills?|(?:jlpt )?n[1-5]))",
    r"(?:korean|tieng han)(?: (?:communication|proficiency|language|skills?|topik(?: level)? [1-6]))",
    r"(?:chinese|tieng trung)(?: (?:communication|proficiency|language|skills?|hsk(?: level)? [1-6]))",
)


def raw_skills(v: Column, source: Column) -> Column:
    others = _flat(F.array(*[pl.at(v, f) for f in ("skills_arr", "extra_skills", "skills_str")]), pl.texts)
    return distinct_ignoring_case(by_source(source, pl.texts(pl.at(v, "skills")), others))


def is_language_skill(name: Column) -> Column:
    return let(fold(name), lambda t: t.isin(*LANGUAGE_SKILLS) | t.rlike("^(?:" + "|".join(LANGUAGE_SKILL_WORDINGS) + ")$"))


def group_of_skill(name: Column) -> Column:
    """The first group that lists a skill's folded name, else other."""
    pairs = {n: g for g, names in reversed(dictionaries.SKILL_GROUPS.items()) for n in names}
    table = lookup_map(pairs)
    return F.coalesce(table[fold(name)], F.lit("other"))


def skills(names: Column) -> Column:
    """array<struct<name, category>>: languages dropped, aliases expanded (one may stand for several), each name once."""
    table = F.create_map(*[x for k, v in dictionaries.SKILL_ALIASES.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))])
    plain = F.filter(names, lambda x: ~is_language_skill(x))
    expanded = distinct_ignoring_case(F.flatten(F.transform(plain, lambda x: F.coalesce(table[fold(x)], clean_items(F.array(x))))))
    return F.transform(F.filter(expanded, lambda x: x.isNotNull()), lambda x: F.struct(x.alias("name"), group_of_skill(x).alias("category")))


def skills_meta(names: Column, source: Column) -> Column:
    moved = F.filter(names, is_language_skill)
    told = F.when(F.size(moved) > 0, F.array(F.concat(F.lit("moved to foreign_languages: "), F.array_join(moved, ", ")))).otherwise(no_texts())
    return meta(by_source(source, F.lit("raw.skills"), F.lit("raw.skills_arr/extra_skills")), F.lit("high"), names, told)


# -- roles -------------------------------------------------------------------------------------------------------
#: Roles that a folded title stands for, by words in any order.
TITLE_ROLES = {
    "AI Engineer": r"(?=.*\b(?:ai|artificial intelligence)\b)(?=.*\b(?:engineer|developer)\b)",
    "iOS Developer": r"(?=.*\bios\b)(?=.*\b(?:engineer|developer)\b)",
    "Android Developer": r"(?=.*\bandroid\b)(?=.*\b(?:engineer|developer)\b)",
    "Security Engineer": r"(?=.*\b(?:security|cybersecurity|appsec)\b)(?=.*\bengineer\b)",
    "Technical Architect": r"\b(?:technical|enterprise) architect\b",
    "SAP Developer": r"(?=.*\bsap\b)(?=.*\bdeveloper\b)",
    "Software Developer / Engineer": r"\bsoftware (?:developer|engineer|engineering)\b",
}


def title_roles(title: Column) -> Column:
    return let(fold(title), lambda t: F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(role)) for role, p in TITLE_ROLES.items()])))


def job_roles(matches: Column, title: Column) -> Column:
    """struct<roles, meta> from array<struct<role, keyword, field>>: roles of the title before those of other fields."""

    def chosen(k: Column) -> Column:
        of_title = F.filter(k["m"], lambda m: m["field"] == "title")
        others = F.filter(k["m"], lambda m: m["field"] != "title")
        roles = lambda some: F.transform(some, lambda m: m["role"])
        both = F.struct(of_title.alias("of_title"), others.alias("others"), distinct_ignoring_case(F.concat(roles(of_title), k["t"])).alias("by_title"), distinct_ignoring_case(roles(others)).alias("by_fields"))
        return let(both, told)

    def told(k: Column) -> Column:
        of_title, others, by_title, by_fields = (k[c] for c in ("of_title", "others", "by_title", "by_fields"))
        words = lambda some: F.transform(some, lambda m: m["keyword"])
        named = F.size(by_title) > 0
        pick = F.when(named, by_title).otherwise(by_fields)
        evidence = F.when(named, F.when(F.size(of_title) > 0, words(of_title)).otherwise(F.array(title))).otherwise(words(others))
        extra = F.array_except(by_fields, by_title)
        against = F.when(named & (F.size(extra) > 0), F.array(F.concat(F.lit("source_role_fields: "), F.array_join(extra, ", ")))).otherwise(no_texts())
        where = F.when(named, "title").when(F.size(by_fields) > 0, "source_role_fields")
        return F.struct(pick.alias("roles"), meta(where, F.when(where.isNotNull(), "high").otherwise("none"), evidence, against).alias("meta"))

    return let(F.struct(matches.alias("m"), title_roles(title).alias("t")), chosen)


# -- language of the posting -------------------------------------------------------------------------------------
#: Fields that state a posting's language, and the names of the two that are served, on folded text.
LANGUAGE_KEYS = ("inLanguage", "in_language", "content_language", "posting_language")
STATED_ENGLISH = ("en", "en us", "en gb", "english", "tieng anh")
STATED_VIETNAMESE = ("vi", "vi vn", "vietnamese", "tieng viet")


def stated_language(v: Column) -> Column:
    """vi, en or other, if the payload says so."""
    of_data = _flat(pl.members(pl.at(v, "json_ld")), lambda x: pl.nested_texts(pl.at(x, "inLanguage")))
    said = F.transform(F.concat(_flat(F.array(*[pl.at(v, k) for k in LANGUAGE_KEYS]), pl.nested_texts), of_data), fold_plain)
    first = F.get(F.filter(said, lambda x: x != ""), 0)
    return let(first, lambda x: F.when(x.isin(*STATED_ENGLISH), "en").when(x.isin(*STATED_VIETNAMESE), "vi").when(x.isNotNull(), "other"))


# -- experience and levels ---------------------------------------------------------------------------------------
def experience(v: Column, text: Column, source: Column, units: Column) -> Column:
    """struct<text, low, high, relation, source> from the stated months, the experience field, or the requirements, whose statements are
    `units`; text maps field names to readable text."""
    primary = F.when(source == "topdev", text["experience"])
    months = F.when(source == "itviec", rules.months_of_experience(pl.scalar(pl.at(v, "experience_requirements_structured", "monthsOfExperience"))))
    found = F.struct(rules.general_statements(primary).alias("p"), rules.general_of(units).alias("r"), months.alias("m"))

    def chosen(k: Column) -> Column:
        own = F.size(k["p"]) > 0
        e = F.coalesce(k["m"], rules.experience_of(F.when(own, k["p"]).otherwise(k["r"])))
        where = F.when(k["m"].isNotNull(), "raw.experience_requirements_structured.monthsOfExperience").when(own, "raw.experience").otherwise("requirements")
        return let(e, lambda x: F.when(x.isNotNull(), F.struct(*[x[c].alias(c) for c in ("text", "low", "high", "relation")], where.alias("source"))))

    return let(found, chosen)


def requirements_text(text: Column, source: Column) -> Column:
    return by_source(source, text["your_skills_and_experience"], F.coalesce(text["requirements_original"], text["requirements"]))


def declared_levels(v: Column, source: Column) -> Column:
    """Levels that the source itself states."""
    first = lambda *fields: F.coalesce(*[F.when(F.size(x) > 0, x) for x in (pl.texts(pl.at(v, f)) for f in fields)], no_texts())
    return rules.declared_levels(by_source(source, first("seniority_declared", "accepted_levels"), first("job_levels_arr", "job_levels_str")))


# -- salary ------------------------------------------------------------------------------------------------------
def salary(v: Column) -> Column:
    """struct<text, low, high, currency, period, basis, status> of the payload's salary: an object with bounds, or a text."""
    return let(pl.at(v, "salary"), _salary_field)


def _salary_field(field: Column) -> Column:
    inner = lambda *path: pl.at(field, *path)
    text = clean_once(F.when(pl.is_object(field), pl.first_true(inner("text"), inner("value"))).otherwise(truthy_scalar(field)))
    read = F.struct(
        text.alias("text"),
        pl.positive_decimal(inner("min_filter"), inner("min"), inner("structured", "value", "minValue")).alias("low"),
        pl.positive_decimal(inner("max_filter"), inner("max"), inner("structured", "value", "maxValue")).alias("high"),
        pl.positive_decimal(inner("structured", "value", "value")).alias("exact"),
        clean_once(pl.first_true(inner("currency"), inner("structured", "currency"), inner("structured", "salaryCurrency"))).alias("currency"),
        fold(pl.first_true(inner("unit"), inner("structured", "value", "unitText"))).alias("unit"),
        F.lower(F.coalesce(pl.first_true(inner("visibility")), F.lit(""))).alias("visibility"),
        F.lower(F.coalesce(pl.first_true(inner("is_negotiable")), F.lit(""))).isin("1", "true", "yes").alias("negotiable"),
    )
    return let(read, lambda r: let(rules.salary(r["text"]), lambda told: _salary(r, told)))


def truthy_scalar(v: Column) -> Column:
    return pl.truthy(pl.scalar(v))


def _salary(r: Column, told: Column) -> Column:
    stated = r["low"].isNotNull() | r["high"].isNotNull() | r["exact"].isNotNull()
    money = "decimal(20,4)"
    low = F.when(r["low"].isNull() & r["high"].isNull(), F.coalesce(r["exact"], told["low"].cast(money))).otherwise(r["low"])
    high = F.when(r["low"].isNull() & r["high"].isNull(), F.coalesce(r["exact"], told["high"].cast(money))).otherwise(r["high"])
    hidden, talk = F.contains(r["visibility"], F.lit("login_required")), r["negotiable"] | (told["status"] == "negotiable")
    shown = ~hidden & ~talk
    some = stated | told["low"].isNotNull() | told["high"].isNotNull()
    period = F.lit(None).cast("string")
    for name, local in (("year", "nam"), ("month", "thang"), ("day", "ngay"), ("hour", "gio")):
        period = F.when(F.contains(r["unit"], F.lit(name)) | F.contains(r["unit"], F.lit(local)) | F.coalesce(told["periods"][name], F.lit(False)), name).otherwise(period)
    currency = F.coalesce(r["currency"], told["currency"])
    return F.struct(
        r["text"].alias("text"),
        F.when(shown, F.when(low > high, high).otherwise(low)).alias("low"),
        F.when(shown, F.when(low > high, low).otherwise(high)).alias("high"),
        F.when(currency.rlike("^[A-Za-z]{3}$"), F.upper(currency)).alias("currency"),
        period.alias("period"),
        told["basis"].alias("basis"),
        F.when(hidden, "unknown").when(talk, "negotiable").when(some, "disclosed").when(r["text"].isNull(), "not_disclosed").otherwise("unknown").alias("status"),
    )


# -- description, education --------------------------------------------------------------------------------------
#: Headings of a description and the fields that may hold them, in this order.
ITVIEC_PARTS = (("Job description", "job_description"), ("Requirements", "your_skills_and_experience"), ("Benefits", "why_youll_love_working_here"), ("Reasons to join", "top_reasons_to_join"))
TOPDEV_PARTS = (
    ("Responsibilities", ("responsibilities_original", "responsibilities", "descriptions", "description")),
    ("Requirements", ("requirements_original", "requirements")),
    ("Benefits", ("benefits_original", "benefits")),
)


def description(text: Column, source: Column) -> Column:
    """The text of a posting: its sections, or its fields under headings."""
    part = lambda heading, body: F.when(body.isNotNull(), F.concat(F.lit(heading + "\n"), body))
    itviec = F.coalesce(text["sections"], F.concat_ws("\n\n", *[part(h, text[f]) for h, f in ITVIEC_PARTS]))
    other = F.concat_ws("\n\n", *[part(h, F.coalesce(*[text[f] for f in fields])) for h, fields in TOPDEV_PARTS])
    return F.nullif(F.trim(by_source(source, itviec, other)), F.lit(""))


def description_source(text: Column, source: Column) -> Column:
    first = lambda fields: F.coalesce(*[F.when(text[f].isNotNull(), F.lit(f"raw.{f}")) for f in fields], F.lit("raw"))
    return by_source(source, first(("sections", *(f for _, f in ITVIEC_PARTS))), first([f for _, fields in TOPDEV_PARTS for f in fields]))


def education(text: Column, source: Column) -> Column:
    degree = clean_text(F.when(source == "itviec", text["education_requirements_structured"]))
    none = F.array().cast("array<struct<degree:string,majors:array<string>>>")
    return F.when(degree.isNotNull(), F.array(F.struct(degree.alias("degree"), no_texts().alias("majors")))).otherwise(none)
