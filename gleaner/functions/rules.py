"""Business rules over posting text, each a Column function: experience, seniority, salary, work mode, languages, places."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_items, clean_once, clean_text, fold, fold_pattern, let, lookup_map, strip_marks, tree_pattern

# -- experience --------------------------------------------------------------------------------------------------
#: The number, year and month patterns of this section.
_NUM, _YEAR, _MONTH = r"(\d+(?:[.,]\d+)?)", r"(?:years?|yrs?|nam)", r"(?:months?|thang)"
_RANGE = rf"\b{_NUM}\s*(?:-|to|den|toi)\s*{_NUM}\s*{_YEAR}\b"
_UNDER = rf"\b(?:under|less than|below|duoi)\s*{_NUM}\s*{_YEAR}\b"
#: Lower bounds, the most explicit wording first.
_LOWER = (
    rf"\b(?:at least|minimum|min|from|more than|over|tu|tren|toi thieu)\s*{_NUM}\s*{_YEAR}\b",
    rf"\b{_NUM}\s*\+\s*{_YEAR}\b",
    rf"\b{_NUM}\s*{_YEAR}(?:\s+of)?\s+(?:professional\s+)?(?:work\s+)?experience\b",
    rf"\b{_NUM}\s*nam\s+kinh nghiem(?:\s+lam viec)?\b",
    rf"\bkinh nghiem(?:\s+[a-z]+){{0,6}}\s+{_NUM}\s*nam\b",
)
_MONTHS = rf"\b(?:at least|minimum|min|from|tu|toi thieu)?\s*{_NUM}\s*{_MONTH}(?:(?:\s+of)?\s+(?:work\s+)?experience|\s+kinh nghiem(?:\s+lam viec)?)\b"
#: What every statement that bounds years holds: a number before a word for years or months.
_BOUNDED = r"\d\s*\+?\s*(?:year|yr|nam|month|thang)"
#: Technology names that make a number of years specific, and phrases that make it general again.
TECHNOLOGIES = (
    "java", "python", "javascript", "typescript", "react", "reactjs", "angular", "vue", "nodejs", "golang", "go", "c++", "c#", "php",
    "ruby", "kotlin", "swift", "sql", "aws", "azure", "gcp", "docker", "kubernetes", "sap", "oracle", "spring", "net",
)
GENERAL_PHRASES = (
    "overall", "total experience", "professional experience", "work experience", "software development", "data engineering",
    "similar role", "similar position", "kinh nghiem o vi tri", "kinh nghiem tai vi tri", "kinh nghiem trong linh vuc",
)


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return let(F.regexp_extract(text, pattern, group), lambda x: F.when(x != "", F.replace(x, F.lit(","), F.lit(".")).cast("double")))


def experience_bounds(text: Column) -> Column:
    """struct<low, high, relation> of a statement: a range, then an upper bound, then lower bounds, then months."""
    return let(fold_pattern(text), _bounds)


def _bounds(t: Column) -> Column:
    a, b = _number(t, _RANGE, 1), _number(t, _RANGE, 2)
    under = _number(t, _UNDER)
    lower = F.coalesce(*[_number(t, p) for p in _LOWER], _number(t, _MONTHS) / 12)
    made = lambda low, high, relation: F.struct(low.cast("double").alias("low"), high.cast("double").alias("high"), F.lit(relation).alias("relation"))
    found = (
        F.when(a.isNotNull(), made(F.least(a, b), F.greatest(a, b), "range"))
        .when(under.isNotNull(), made(F.lit(0.0), under, "under"))
        .otherwise(let(lower, lambda x: F.when(x.isNotNull(), made(x, F.lit(None), "minimum"))))
    )
    return F.when(t.rlike(_BOUNDED), found)


def is_general_experience(text: Column) -> Column:
    """Whether the years of a statement are those of the profession, not of one technology."""
    return experience_bounds(text).isNotNull() & let(fold_pattern(text), _is_general)


def _is_general(t: Column) -> Column:
    escaped = "|".join(x.replace("+", r"\+") for x in TECHNOLOGIES)
    return ~t.rlike(rf"(?<!\w)(?:{escaped})(?!\w)") | t.rlike("|".join(GENERAL_PHRASES))


def statements(text: Column) -> Column:
    """Sentences and list items of a text."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\R")
    units = F.flatten(F.transform(lines, lambda x: F.split(x, r"(?<=[.!?])\s+|\s*[;•]\s*")))
    return clean_items(units)


def general_of(units: Column) -> Column:
    """array<struct<text, bounds>>: the statements that bound the years of the profession, each folded once."""

    def read(x: Column) -> Column:
        told = lambda t: let(_bounds(t), lambda b: F.when(b.isNotNull() & _is_general(t), F.struct(x.alias("text"), b.alias("bounds"))))
        return let(fold_pattern(x), told)

    return F.array_compact(F.transform(units, read))


def general_statements(text: Column) -> Column:
    """The statements of a text that bound the years of the profession, with their bounds."""
    return general_of(statements(text))


def experience_of(found: Column) -> Column:
    """struct<text, low, high, relation> of general statements; bounds that cross are a conflict without bounds."""

    def whole(k: Column) -> Column:
        crossed = F.struct(F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit("conflict").alias("relation"))
        b = F.coalesce(k["b"], F.when(F.size(k["s"]) > 0, crossed))
        text = F.array_join(F.transform(k["s"], lambda x: x["text"]), "\n")
        return F.when(F.size(k["s"]) > 0, F.struct(text.alias("text"), b["low"].alias("low"), b["high"].alias("high"), b["relation"].alias("relation")))

    strongest = lambda s: let(F.transform(s, lambda x: x["bounds"]), _strongest)
    return let(found, lambda s: let(F.struct(s.alias("s"), strongest(s).alias("b")), whole))


def months_of_experience(months: Column) -> Column:
    """struct<text, low, high, relation> of a number of months; a half of a hundredth of a year goes to the even side."""
    m = months.try_cast("decimal(12,4)")
    shown = F.regexp_replace(m.cast("string"), r"\.?0+$", "")
    made = F.struct(
        F.concat(shown, F.lit(" months of experience")).alias("text"), F.bround(m / 12, 2).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit("minimum").alias("relation")
    )
    return F.when(m >= 0, made)


def experience(text: Column) -> Column:
    """struct<low, high, relation> of a whole text: the strongest of the general statements; none if they cross."""
    return let(F.transform(general_statements(text), lambda x: x["bounds"]), _strongest)


def _strongest(found: Column) -> Column:
    low = F.array_max(F.transform(found, lambda x: x["low"]))
    high = F.array_min(F.filter(F.transform(found, lambda x: x["high"]), lambda x: x.isNotNull()))
    relation = F.when(F.size(found) == 1, F.element_at(found, 1)["relation"]).otherwise(F.when(high.isNotNull(), "range").otherwise("minimum"))
    whole = F.struct(low.alias("low"), high.alias("high"), relation.alias("relation"))
    return F.when((F.size(found) > 0) & ~F.coalesce(low > high, F.lit(False)), whole)


def experience_levels(low: Column, high: Column, relation: Column) -> Column:
    """Levels whose band of years ([0,1), [1,3), [3,5), [5,)) the bounds touch; none if they touch more than two."""
    reaches = lambda edge: F.when(relation == "under", high > edge).otherwise(high >= edge)
    touched = F.array_compact(
        F.array(
            F.when((low < 1) & reaches(0), F.lit("Fresher")),
            F.when((low < 3) & reaches(1), F.lit("Junior")),
            F.when((low < 5) & reaches(3), F.lit("Mid-level")),
            F.when(reaches(5), F.lit("Senior")),
        )
    )
    none = F.array().cast("array<string>")
    single = F.array(F.when(low < 1, "Fresher").when(low < 3, "Junior").when(low < 5, "Mid-level").otherwise("Senior"))
    return (
        F.when((relation == "under") & (high <= 1), F.array(F.lit("Fresher")))
        .when(low.isNull(), none)
        .when(high.isNotNull(), F.when(F.size(touched) <= 2, touched).otherwise(none))
        .otherwise(single)
    )


# -- seniority ---------------------------------------------------------------------------------------------------
#: Words of each level, in the order in which a declared level is read.
LEVEL_WORDS = {
    "All levels": r"\b(all levels?|tat ca cap bac|moi cap do)\b",
    "Intern": r"\b(intern|internship|thuc tap|thuc tap sinh)\b",
    "Fresher": r"\b(fresher|entry level|moi tot nghiep)\b",
    "Junior": r"\b(junior|jr)\b",
    "Mid-level": r"\b(middle|mid level|midlevel)\b",
    "Senior": r"\b(senior|sr|chuyen vien cap cao|chuyen vien cao cap|cvcc)\b",
    "Lead": r"\b(lead|leader|truong nhom|head)\b",
    "Principal": r"\bprincipal\b",
    "Architect": r"\barchitect\b",
    "Director": r"\b(director|giam doc)\b",
    "CTO": r"\bcto\b|chief technology officer",
    "CIO": r"\bcio\b|chief information officer",
}
#: In a title a specific position outranks a general one, so the order differs.
TITLE_ORDER = ("All levels", "CTO", "CIO", "Director", "Principal", "Architect", "Lead", "Senior", "Mid-level", "Junior", "Fresher", "Intern")
TITLE_WORDS = {**LEVEL_WORDS, "All levels": r"\b(all levels?|tat ca cap bac)\b", "Senior": r"\b(senior|sr|expert|chuyen vien cap cao|chuyen vien cao cap|cvcc)\b"}


def _first_rule(text: Column, rules: list[tuple[str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def declared_level(value: Column) -> Column:
    return let(fold(value), lambda t: _first_rule(t, list(LEVEL_WORDS.items())))


def declared_levels(values: Column) -> Column:
    found = F.array_distinct(F.filter(F.transform(values, declared_level), lambda x: x.isNotNull()))
    return F.when(F.array_contains(found, "All levels"), F.array(F.lit("All levels"))).otherwise(found)


def title_level(title: Column) -> Column:
    return let(fold(title), lambda t: _first_rule(t, [(name, TITLE_WORDS[name]) for name in TITLE_ORDER]))


def seniority(declared: Column, title: Column, by_experience: Column, names: tuple[str, str, str] = ("source", "title", "experience")) -> Column:
    """struct<levels, source, conflicts>: declared levels before the title's before those of the experience."""
    none = F.array().cast("array<string>")
    known = F.struct(F.coalesce(declared, none).alias("d"), F.array_compact(F.array(title_level(title))).alias("t"), F.coalesce(by_experience, none).alias("e"))
    return let(known, lambda k: _precedence([(n, k[c]) for n, c in zip(names, "dte", strict=True)]))


def _precedence(named: list[tuple[str, Column]]) -> Column:
    levels, source = F.array().cast("array<string>"), F.lit(None).cast("string")
    for name, found in reversed(named):
        some = F.size(found) > 0
        levels, source = F.when(some, found).otherwise(levels), F.when(some, F.lit(name)).otherwise(source)
    differs = [F.when((F.size(v) > 0) & (source != n) & (F.sort_array(v) != F.sort_array(levels)), F.concat(F.lit(f"{n}: "), F.array_join(v, ", "))) for n, v in named]
    return F.struct(levels.alias("levels"), source.alias("source"), F.array_compact(F.array(*differs)).alias("conflicts"))


# -- salary ------------------------------------------------------------------------------------------------------
_TOKEN = r"(?U)(?<!\w)(\d+(?:[.,]\d+)*)(?!\w)"


def salary_number(token: Column, multiplier: Column) -> Column:
    grouped = token.rlike(r"^\d{1,3}([.,]\d{3})+$")
    short = (multiplier > 1) & token.rlike(r"^\d+[.,]\d{1,2}$")
    plain = F.when(~short & grouped, F.regexp_replace(token, "[.,]", "")).otherwise(F.replace(token, F.lit(","), F.lit(".")))
    value = plain.try_cast("double") * multiplier
    return F.when(value > 0, value)


def salary_bounds(text: Column) -> Column:
    """struct<low, high> of a salary text; thousands and millions are multiplied out."""
    return let(fold(text), lambda t: _salary_bounds(t, text))


def _salary_bounds(t: Column, text: Column) -> Column:
    multiplier = F.when(t.rlike(r"\b(trieu|million|tr)\b"), 1e6).when(t.rlike(r"(?<!\w)k(?!\w)"), 1e3).otherwise(1.0)
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), 1)
    numbers = F.filter(F.transform(found, lambda x: salary_number(x, multiplier)), lambda x: x.isNotNull())
    return let(numbers, lambda n: _salary_order(n, t, text))


def _salary_order(numbers: Column, t: Column, text: Column) -> Column:
    first, second = F.get(numbers, 0), F.get(numbers, 1)
    made = lambda low, high: F.struct(low.cast("double").alias("low"), high.cast("double").alias("high"))
    none = F.lit(None)
    return (
        F.when(F.size(numbers) == 0, made(none, none))
        .when(t.rlike(r"\b(up to|max(imum)?|toi da)\b"), made(none, first))
        .when(t.rlike(r"\b(from|min(imum)?|tu)\b") | F.contains(text, F.lit("+")), made(first, none))
        .when(second.isNotNull(), made(F.least(first, second), F.greatest(first, second)))
        .otherwise(made(first, first))
    )


def salary(text: Column) -> Column:
    """struct<low, high, currency, period, basis, status> of a salary text."""
    return let(fold(text), lambda t: let(_salary_bounds(t, text), lambda b: _salary(t, b, text)))


#: Words of each pay period, in the order in which they are looked for.
PERIODS = (("hour", "gio"), ("day", "ngay"), ("month", "thang"), ("year", "nam"))


def _salary(t: Column, bounds: Column, text: Column) -> Column:
    talk = t.rlike(r"\b(negotiable|thoa thuan|thuong luong)\b")
    flags = F.struct(talk.alias("talk"), *[t.rlike(rf"\b({name}|{local})\b").alias(name) for name, local in PERIODS])
    return let(flags, lambda k: _salary_told(t, bounds, text, k))


def _salary_told(t: Column, bounds: Column, text: Column, flags: Column) -> Column:
    raw, talk = F.coalesce(text, F.lit("")), flags["talk"]
    some = bounds["low"].isNotNull() | bounds["high"].isNotNull()
    named = [(name, flags[name]) for name, _ in PERIODS]
    return F.struct(
        F.when(~talk, bounds["low"]).alias("low"),
        F.when(~talk, bounds["high"]).alias("high"),
        F.when(t.rlike(r"\b(vnd|trieu)\b"), "VND").when(t.rlike(r"\busd\b") | F.contains(raw, F.lit("$")), "USD").alias("currency"),
        F.coalesce(*[F.when(found, F.lit(name)) for name, found in named]).alias("period"),
        F.when(t.rlike(r"\bgross\b"), "gross").when(t.rlike(r"\bnet\b"), "net").alias("basis"),
        F.when(clean_text(text).isNull(), "not_disclosed").when(talk, "negotiable").when(some, "disclosed").otherwise("unknown").alias("status"),
        F.struct(*[found.alias(name) for name, found in named]).alias("periods"),
    )


# -- work mode, languages, places --------------------------------------------------------------------------------
#: Wordings of each work mode, on folded text.
WORK_MODES = {
    "remote": r"^remote$|\bfully remote\b|\bremote (?:work|working|job|position|role|option)\b|\bwork(?:ing)? remotely\b|\bwfh\b|\bwork from home\b|\blam viec tu xa\b",
    "hybrid": r"^hybrid$|\bhybrid (?:work|working|model|mode|position|role)\b|\bwork(?:ing)? (?:in )?hybrid\b|\blinh hoat\b",
    "onsite": r"^onsite$|^on site$|\bonsite (?:work|working|job|position|role)\b|\bon site\b|\bat office\b|\btai van phong\b|\btruc tiep\b",
}


#: Of these, every wording of a mode holds one; a text without them isn't searched by pattern.
WORK_MODE_WORDS = {"remote": ("remote", "wfh", "work from home", "lam viec tu xa"), "hybrid": ("hybrid", "linh hoat"), "onsite": ("onsite", "on site", "at office", "tai van phong", "truc tiep")}


def work_modes(text: Column) -> Column:
    def named(t: Column, name: str) -> Column:
        held = reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in WORK_MODE_WORDS[name]])
        return F.when(held, F.when(t.rlike(WORK_MODES[name]), F.lit(name)))

    return let(fold(text), lambda t: F.array_compact(F.array(*[named(t, name) for name in WORK_MODES])))


def work_mode(explicit: Column, description: Column) -> Column:
    """The one mode of the explicit field, else the one mode of the description, else null."""
    return let(both_work_modes(explicit, description), work_mode_of)


def both_work_modes(explicit: Column, description: Column) -> Column:
    """struct<a, b>: the modes that the explicit field names, and those that the description does."""
    return F.struct(work_modes(explicit).alias("a"), work_modes(description).alias("b"))


def work_mode_of(k: Column) -> Column:
    """work_mode of both_work_modes."""
    return F.when(F.size(k["a"]) == 1, F.get(k["a"], 0)).when(F.size(k["b"]) == 1, F.get(k["b"], 0))


def work_mode_conflicts(explicit: Column, description: Column) -> Column:
    """What speaks against the work mode that was chosen."""
    return let(both_work_modes(explicit, description), work_mode_conflicts_of)


def work_mode_conflicts_of(k: Column) -> Column:
    """work_mode_conflicts of both_work_modes."""
    named = lambda x: F.concat(F.lit("description: "), x)
    one = F.transform(F.array_except(k["b"], k["a"]), named)
    many = F.array_compact(
        F.array(F.when(F.size(k["a"]) > 1, F.lit("explicit field contains multiple work modes")), F.when(F.size(k["b"]) > 1, named(F.array_join(k["b"], ", "))))
    )
    return F.when(F.size(k["a"]) == 1, one).otherwise(many)


#: Names of each foreign language, on folded text, and its certificates, on the text itself.
LANGUAGES = {
    "English": (r"\b(english|tieng anh|toeic|ielts|cefr)\b", (
        r"\bTOEIC\s*(?:score\s*(?:of\s*)?)?\d{3,4}\b",
        r"\bIELTS\s*(?:score\s*(?:of\s*)?)?\d(?:[.,]\d)?\b",
        r"\bCEFR\s*[ABC][12]\b",
        r"\bEnglish\s*(?:level\s*)?[ABC][12]\b",
        r"\b[ABC][12]\s+English\b",
    )),
    "Japanese": (r"\b(japanese|tieng nhat|jlpt)\b", (r"\bJLPT\s*N[1-5]\b", r"\bJapanese\s*(?:level\s*)?N[1-5]\b")),
    "Korean": (r"\b(korean|tieng han|topik)\b", (r"\bTOPIK\s*(?:level\s*)?[1-6]\b",)),
    "Chinese": (r"\b(chinese|mandarin|tieng trung|hsk)\b", (r"\bHSK\s*(?:level\s*)?[1-6]\b",)),
}
#: Wordings of a level of English.
ENGLISH_WORDINGS = (
    r"\b(?:fluent|proficient|advanced|business)\s+(?:in\s+)?English\b",
    r"\b(?:basic|intermediate|advanced|good|strong)\s+(?:at\s+)?English(?:\s+(?:skills?|communication|reading|writing|speaking|comprehension))?\b",
    r"\bEnglish\s+(?:fluency|proficiency|communication|communicative)\b",
    r"\bEnglish\s+(?:reading|writing|speaking)\s+(?:skills?|comprehension)\b",
    r"\b(?:good|strong)\s+(?:communication\s+)?of\s+English\b",
    r"\b(?:able to|can)\s+communicate\s+in\s+English\b",
    r"\b(?:thanh thao|giao tiep tot|giao tiep)\s+(?:bang\s+)?tieng Anh\b",
    r"\btieng Anh\s+(?:thanh thao|giao tiep tot|giao tiep)\b",
    r"(?:thành thạo|giao tiếp tốt|giao tiếp|đọc hiểu)\s+(?:bằng\s+)?tiếng Anh",
    r"tiếng Anh\s+(?:thành thạo|giao tiếp tốt|giao tiếp|đọc hiểu)",
)
#: Names of the other languages in wordings of a level.
OTHER_NAMES = {"Japanese": "Japanese", "Korean": "Korean", "Chinese": "(?:Chinese|Mandarin)"}


def level_wordings(language: str) -> tuple[str, ...]:
    """Patterns of a level, certificates first."""
    if language in OTHER_NAMES:
        name = OTHER_NAMES[language]
        words = (rf"\b(?:fluent|proficient|business)\s+(?:in\s+)?{name}\b", rf"\b{name}\s+(?:fluency|proficiency|communication)\b", rf"\b(?:able to|can)\s+communicate\s+in\s+{name}\b")
    else:
        words = ENGLISH_WORDINGS
    return (*LANGUAGES[language][1], *words)


def foreign_languages(text: Column, skills: Column | None = None) -> Column:
    """array<struct<language, level_text, evidence>>: the languages that a sentence of the text or a skill names, with a certificate or
    a wording of the level; one entry 'unknown' if there is none."""
    return languages_of(statements(text), skills)


def languages_of(units: Column, skills: Column | None = None) -> Column:
    """foreign_languages of statements."""
    units = F.concat(units, F.coalesce(skills, F.array().cast("array<string>"))) if skills is not None else units
    folded = F.transform(units, lambda u: F.struct(u.alias("u"), fold(u).alias("t")))
    spoken = r"\b(?:" + "|".join(words.removeprefix(r"\b").removesuffix(r"\b") for words, _ in LANGUAGES.values()) + r")\b"
    return let(F.filter(folded, lambda x: x["t"].rlike(spoken)), _languages)


def _languages(units: Column) -> Column:
    def entry(name: str, words: str) -> Column:
        evidence = F.transform(F.filter(units, lambda x: x["t"].rlike(words)), lambda x: x["u"])
        return let(evidence, lambda e: F.when(F.size(e) > 0, _language(name, e)))

    found = [entry(name, words) for name, (words, _) in LANGUAGES.items()]
    listed = F.array_compact(F.array(*found))
    none = F.lit(None).cast("string")
    unknown = F.struct(F.lit("unknown").alias("language"), none.alias("level_text"), F.array().cast("array<string>").alias("evidence"))
    return F.when(F.size(listed) > 0, listed).otherwise(F.array(unknown))


def _language(name: str, evidence: Column) -> Column:
    def level(text: Column) -> Column:
        return F.coalesce(*[clean_once(F.regexp_extract(text, f"(?iU)({p})", 1)) for p in level_wordings(name)])

    return F.struct(F.lit(name).alias("language"), let(F.array_join(evidence, "\n"), level).alias("level_text"), evidence.alias("evidence"))


def places_in(text: Column, aliases: dict[str, str]) -> Column:
    """Places by their aliases in order of appearance: longer aliases win where two overlap, each place once."""
    t = F.replace(fold(text), F.lit("."), F.lit(" "))
    hits = F.regexp_extract_all(t, F.lit(r"(?<![a-z0-9])(" + tree_pattern(sorted(aliases)) + r")(?![a-z0-9])"), 1)
    names = lookup_map(aliases)
    return F.array_distinct(F.transform(hits, lambda a: names[a]))


# -- language gate -----------------------------------------------------------------------------------------------
#: Words that speak for each language of a posting.
VIETNAMESE = (
    "va", "voi", "cua", "cho", "cac", "trong", "cong viec", "yeu cau", "kinh nghiem", "ky nang", "ung vien", "lam viec",
    "quyen loi", "mo ta", "phat trien", "he thong", "du lieu", "tieng viet",
)
ENGLISH = (
    "and", "with", "the", "for", "from", "job", "work", "requirements", "experience", "skills", "candidate", "develop", "development",
    "engineer", "developer", "manager", "data", "software", "system", "support", "english",
)
OTHER_LATIN = (
    "les", "une", "avec", "pour", "nous", "vous", "travail", "poste", "und", "mit", "fur", "erfahrung", "kenntnisse", "arbeit", "los", "las",
    "una", "con", "para", "experiencia", "habilidades", "trabajo", "uma", "trabalho", "vaga", "dan", "dengan", "untuk", "pekerjaan",
)
OTHER_SCRIPTS = r"[\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7af}\x{1100}-\x{11ff}\x{0400}-\x{04ff}\x{0600}-\x{06ff}\x{0e00}-\x{0e7f}]"


def posting_language(text: Column) -> Column:
    """vi, en, other or unknown, by scripts, Vietnamese letters and words of the three groups."""
    return let(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " "), lambda body: let(_tokens(body), lambda t: _posting_language(body, t)))


def _tokens(body: Column) -> Column:
    return F.trim(F.regexp_replace(strip_marks(body), r"[^a-z0-9]+", " "))


def _posting_language(body: Column, t: Column) -> Column:
    counts = _language_counts(body, t)
    return let(counts, lambda k: _decide_language(body, k))


def _language_counts(body: Column, t: Column) -> Column:
    words = lambda listed: F.array(*[F.lit(w) for w in listed])
    # no phrase begins with a word that ends another, so one pass finds them all
    phrases = F.regexp_extract_all(F.concat(F.lit(" "), t, F.lit(" ")), F.lit(" (" + "|".join(VIETNAMESE) + ")(?= )"), 1)
    # letters are counted only where enough signs of other scripts ask for their share
    scripts = body.rlike(_at_least(OTHER_SCRIPTS, 4))
    named = {
        "letters": F.when(scripts, F.regexp_count(body, F.lit(r"\p{L}"))).otherwise(body.rlike(r"\p{L}").cast("int")),
        "foreign": F.when(scripts, F.regexp_count(body, F.lit(OTHER_SCRIPTS))).otherwise(0),
        "marks": F.when(body.rlike(_at_least("[ăâđêôơưĂÂĐÊÔƠƯ]", 2)), 2).otherwise(0),
        "vietnamese": F.size(F.array_distinct(phrases)),
        "named": F.array_intersect(F.split(t, " "), words(ENGLISH + OTHER_LATIN)),
    }
    counted = lambda k: {n: k[n] for n in ("letters", "foreign", "marks", "vietnamese")} | {n: F.size(F.array_intersect(k["named"], words(w))) for n, w in (("english", ENGLISH), ("other", OTHER_LATIN))}
    return let(F.struct(*[c.alias(n) for n, c in named.items()]), lambda k: F.struct(*[c.alias(n) for n, c in counted(k).items()]))


def _at_least(one: str, n: int) -> str:
    """A pattern of texts that hold n or more characters of a class; it stops at the last one that it needs."""
    return one + (f"(?s:[^{one[1:-1]}]*+){one}" * (n - 1))


def _decide_language(body: Column, k: Column) -> Column:
    letters, foreign, marks, vietnamese, english, other = (k[n] for n in ("letters", "foreign", "marks", "vietnamese", "english", "other"))
    return (
        F.when(letters == 0, "unknown")
        .when((foreign >= 4) & (foreign / F.greatest(letters, F.lit(1)) >= 0.12), "other")
        .when((marks >= 2) | ((vietnamese >= 2) & (vietnamese > english)), "vi")
        .when((other >= 3) & (other > english * 2), "other")
        .when((english >= 1) | body.rlike("[A-Za-z]{3,}"), "en")
        .otherwise("unknown")
    )
