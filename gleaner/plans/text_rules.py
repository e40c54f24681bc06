"""Text, rule and extraction queries over documents, pages and texts made from the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionaries, rules
from ..functions import text as tx
from ..operators import atomize, gate
from ..sources import html, pages
from .base import query, t

FOLD_SQL = "trim(regexp_replace(strip_accents(replace(lower({0}), 'ß', 'ss')), '[^a-z0-9+#.]+', ' ', 'g'))"
PLAIN_SQL = "trim(regexp_replace(strip_accents(replace(lower({0}), 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g'))"


@query(f"SELECT doc_id, md5({FOLD_SQL.format('text')}) AS folded, CAST(length({FOLD_SQL.format('text')}) AS BIGINT) AS n FROM documents")
def clean_fold_text(spark, d):
    folded = tx.fold("text")
    return t(spark, d, "documents").select("doc_id", F.md5(folded).alias("folded"), F.length(folded).cast("long").alias("n"))


@query("""SELECT page_id, lower(regexp_extract(url, '(?i)^(https?)://', 1)) || '://' || lower(regexp_extract(url, '(?i)^https?://([^/?#:@]+)', 1))
          || regexp_replace(regexp_extract(url, '(?i)^https?://[^/?#]*([^?#]*)', 1), '/+$', '') AS canonical FROM pages""")
def canonical_url(spark, d):
    return t(spark, d, "pages").select("page_id", tx.canonical_url("url").alias("canonical"))


def _language_sql() -> str:
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(words)) + "]"
    phrases = " + ".join(f"CAST(contains(' ' || f || ' ', ' {w} ') AS INTEGER)" for w in rules.VIETNAMESE)
    return f"""WITH a AS (SELECT doc_id, text, {PLAIN_SQL.format("regexp_replace(text, '<[^>]+>', ' ', 'g')")} AS f FROM documents),
      b AS (SELECT doc_id, text, f, length(regexp_replace(text, '[^\\p{{L}}]+', '', 'g')) AS letters, length(regexp_replace(lower(text), '[^ăâđêôơư]+', '', 'g')) AS marks,
        length(text) - length(regexp_replace(text, '[\\x{{3040}}-\\x{{30ff}}\\x{{3400}}-\\x{{9fff}}\\x{{0400}}-\\x{{04ff}}]', '', 'g')) AS scripts,
        {phrases} AS vi, len(list_intersect(string_split(f, ' '), {listed(rules.ENGLISH)})) AS en, len(list_intersect(string_split(f, ' '), {listed(rules.OTHER_LATIN)})) AS other FROM a)
      SELECT doc_id, CASE WHEN letters = 0 THEN 'unknown' WHEN scripts >= 4 AND scripts >= 0.12 * letters THEN 'other' WHEN marks >= 2 OR (vi >= 2 AND vi > en) THEN 'vi'
        WHEN other >= 3 AND other > en * 2 THEN 'other' WHEN en >= 1 OR regexp_matches(text, '[A-Za-z]{{3,}}') THEN 'en' ELSE 'unknown' END AS language FROM b"""


@query(_language_sql())
def language_gate(spark, d):
    return t(spark, d, "documents").select("doc_id", rules.posting_language(F.col("text")).alias("language"))


#: The driver's texts name no roles, so frequent words of theirs stand in for two roles.
SAMPLE_ROLES = {"Role of": ("of the", "of"), "Role und": ("und die", "und"), **dictionaries.ROLES}


#: Every role and keyword, as DuckDB rows.
ROLE_ROWS = "(VALUES " + ", ".join(f"('{r}', '{k}')" for r, keywords in SAMPLE_ROLES.items() for k in keywords) + ") AS k(role, keyword)"


@query(f"""WITH a AS (SELECT doc_id, ' ' || {PLAIN_SQL.format('text')} || ' ' AS f FROM documents),
           m AS (SELECT doc_id, role, keyword, row_number() OVER (PARTITION BY doc_id, role ORDER BY length(keyword) DESC, keyword) AS nth FROM a, {ROLE_ROWS} WHERE contains(f, ' ' || keyword || ' '))
           SELECT doc_id, role, keyword FROM m WHERE nth = 1""")
def role_gate(spark, d):
    """Every role that a whole text names, by its longest keyword."""
    found = t(spark, d, "documents").select("doc_id", F.explode(gate.role_matches(F.col("text"), SAMPLE_ROLES)).alias("m"))
    return found.select("doc_id", "m.role", "m.keyword")


#: The role catalogue, numbered, each with its folded form.
ROLE_NAMES_SQL = "(VALUES " + ", ".join(f"({n}, '{dictionaries.plain(r)}')" for n, r in enumerate(dictionaries.ROLE_NAMES)) + ") AS"


@query(f"""WITH a AS (SELECT c_custkey, ' senior ' || x.f || ' ' || y.f || ' remote ' AS f FROM customer JOIN {ROLE_NAMES_SQL} x(n, f) ON x.n = c_custkey % {len(dictionaries.ROLE_NAMES)}
             JOIN {ROLE_NAMES_SQL} y(n, f) ON y.n = (c_custkey * 5 + 2) % {len(dictionaries.ROLE_NAMES)}),
           m AS (SELECT c_custkey, role, keyword, row_number() OVER (PARTITION BY c_custkey, role ORDER BY length(keyword) DESC, keyword) AS nth FROM a, {ROLE_ROWS} WHERE contains(f, ' ' || keyword || ' '))
           SELECT role, keyword, count(*) AS n FROM m WHERE nth = 1 GROUP BY 1, 2""")
def role_titles(spark, d):
    """Titles of two catalogue roles each, as they are written: every role of the catalogue is asked for."""
    n, name = len(dictionaries.ROLE_NAMES), lambda k: F.element_at(F.array(*[F.lit(r) for r in dictionaries.ROLE_NAMES]), k.cast("int") + 1)
    title = F.concat(F.lit("Senior "), name(F.col("c_custkey") % n), F.lit(" / "), name((F.col("c_custkey") * 5 + 2) % n), F.lit(" (Remote)"))
    found = t(spark, d, "customer").select(F.explode(gate.role_matches(title, SAMPLE_ROLES)).alias("m"))
    return found.groupBy("m.role", "m.keyword").agg(F.count(F.lit(1)).alias("n"))


def _reasons_sql() -> str:
    keywords = ", ".join(f"' {k} '" for k in sorted({k for words in SAMPLE_ROLES.values() for k in words}))
    return f"""WITH g AS ({_language_sql().replace("SELECT doc_id, CASE", "SELECT doc_id, text, f, CASE")})
      SELECT CASE WHEN trim(text) = '' THEN 'missing_role_text' WHEN language = 'other' THEN 'unsupported_language' WHEN language = 'unknown' THEN 'unknown_language'
        WHEN len(list_filter([{keywords}], lambda k: contains(' ' || f || ' ', k))) > 0 THEN 'matched_role_keyword' ELSE 'no_matching_role_keyword' END AS reason, language, count(*) AS n FROM g GROUP BY 1, 2"""


@query(_reasons_sql())
def gate_reasons(spark, d):
    documents = t(spark, d, "documents").withColumn("body", F.lit(None).cast("string"))  # the role text is the whole text
    return gate.gate(documents, "text", "body", SAMPLE_ROLES).groupBy("reason", "language").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH a AS (SELECT doc_id, {FOLD_SQL.format('text')} AS f FROM documents), m AS (SELECT doc_id, list_filter([{", ".join(f"CASE WHEN regexp_matches(f, '{p}') THEN '{name}' END" for name, p in rules.WORK_MODES.items())}], lambda x: x IS NOT NULL) AS modes FROM a)
  SELECT doc_id, CASE WHEN len(modes) = 1 THEN modes[1] END AS mode, CAST(len(modes) AS INTEGER) AS n_modes FROM m""")
def document_work_mode(spark, d):
    """Work modes named in whole texts."""
    modes = t(spark, d, "documents").select("doc_id", rules.work_modes(F.col("text")).alias("modes"))
    return modes.select("doc_id", F.when(F.size("modes") == 1, F.get("modes", 0)).alias("mode"), F.size("modes").alias("n_modes"))


#: The driver's texts name no Vietnamese places, so frequent words of theirs stand in for two more.
SAMPLE_PLACES = {**dictionaries.PLACES, "the": "The", "of the": "Of the"}


@query(f"""WITH a AS (SELECT doc_id, regexp_extract_all(replace({FOLD_SQL.format('text')}, '.', ' '), '\\b({"|".join(sorted(SAMPLE_PLACES, key=lambda a: (-len(a), a)))})\\b', 1) AS hits FROM documents),
  names AS (SELECT MAP {{{", ".join(f"'{k}': '{v}'" for k, v in SAMPLE_PLACES.items())}}} AS m)
  SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(hits, lambda x: m[x]))), '|') AS places FROM a, names""")
def document_places(spark, d):
    """Places named in whole texts, longer names first."""
    return t(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(rules.places_in(F.col("text"), SAMPLE_PLACES)), "|").alias("places"))


COLOURS = {"red": "Red", "blue": "Blue", "green": "Green", "ivory": "Ivory", "small": "Small"}


@query("""SELECT p_partkey, n AS name FROM (SELECT p_partkey, unnest(list_distinct(string_split(p_type, ' '))) AS n FROM part WHERE p_size % 2 = 0)
          UNION ALL SELECT p_partkey, p_brand FROM part WHERE p_size % 2 = 1""")
def atomize_split(spark, d):
    """Composites whose parts are all known words; the known words are a table here, not a literal map."""
    p = t(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.replace("p_type", F.lit(" "), F.lit("/"))).otherwise(F.col("p_brand")).alias("value"))
    known = t(spark, d, "part").select(F.explode(F.split("p_type", " ")).alias("name")).distinct()
    return atomize.atoms_of_table(p, "p_partkey", "value", known, "name").select("p_partkey", "name")


@query("""SELECT p_partkey, 'skill' AS field_name, p_brand || '/' || p_type AS source_value, 'unresolved_composite' AS reason FROM part WHERE p_size < 5""")
def atomize_issues(spark, d):
    p = t(spark, d, "part").where("p_size < 5").select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("value"))
    return atomize.issues(p, "p_partkey", "value", "skill", atomize.lookup(COLOURS))


#: Skills as sources write them, and what they stand for.
RAW_SKILLS = {
    "ReactJS": (("React", "framework_library"),), "golang": (("Go", "programming_language"),), "C/C++": (("C", "programming_language"), ("C++", "programming_language")),
    "Kafka": (("Kafka", "data_streaming"),), "k8s": (("Kubernetes", "devops"),), "Jira": (("Jira", "tool"),), "postgres": (("PostgreSQL", "database"),),
    "Unit Testing": (("Unit Testing", "testing"),), "RTOS": (("RTOS", "operating_system"),), "OWASP": (("OWASP", "security"),), "Figma": (("Figma", "design"),), "MysteryTech": (("MysteryTech", "other"),),
}


@query(f"""WITH a AS (SELECT p_partkey, [{", ".join(f"'{r}'" for r in RAW_SKILLS)}][1 + p_partkey % {len(RAW_SKILLS)}] AS raw FROM part),
          m(raw, skill, category) AS (VALUES {", ".join(f"('{r}', '{n}', '{c}')" for r, found in RAW_SKILLS.items() for n, c in found)})
          SELECT skill, category, count(*) AS n FROM a JOIN m USING (raw) GROUP BY 1, 2""")
def skill_alias_category(spark, d):
    raw = F.element_at(F.array(*[F.lit(s) for s in RAW_SKILLS]), (F.col("p_partkey") % len(RAW_SKILLS) + 1).cast("int"))
    # Sources write the same skills again and again: each spelling is read once, and each skill it stands for is placed once.
    written = t(spark, d, "part").groupBy(raw.alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    skills = written.select(F.explode(atomize.canonical_skills(F.array("raw"), dictionaries.SKILL_ALIASES)).alias("skill"), "n").groupBy("skill").agg(F.sum("n").alias("n"))
    return skills.select("skill", atomize.skill_category(F.col("skill")).alias("category"), "n")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Bà Rịa - Vũng Tàu|Hồ Chí Minh' WHEN 2 THEN 'Đà Nẵng' ELSE '' END AS cities FROM customer""")
def city_extract(spark, d):
    k = F.col("c_custkey") % 4
    text = F.when(k == 0, "Tầng 3, Hanoi, Hà Nội").when(k == 1, "Bà Rịa - Vũng Tàu; HCMC and Sài Gòn").when(k == 2, "Office in ĐÀ NẴNG").otherwise("Remote")
    return t(spark, d, "customer").select("c_custkey", F.array_join(rules.places_in(text, dictionaries.PLACES), "|").alias("cities"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN least(p_size % 9, p_size % 5) WHEN 1 THEN 0 WHEN 2 THEN p_size % 9 ELSE p_size % 24 / 12.0 END::DOUBLE AS low,
          CASE p_partkey % 4 WHEN 0 THEN greatest(p_size % 9, p_size % 5) WHEN 1 THEN p_size % 9 END::DOUBLE AS high,
          CASE p_partkey % 4 WHEN 0 THEN 'range' WHEN 1 THEN 'under' ELSE 'minimum' END AS relation FROM part""")
def experience_bounds(spark, d):
    found = rules.experience_bounds(_experience_text())
    return t(spark, d, "part").select("p_partkey", found["low"].alias("low"), found["high"].alias("high"), found["relation"].alias("relation"))


def _experience_text():
    k, a, b = F.col("p_partkey") % 4, (F.col("p_size") % 9).cast("string"), (F.col("p_size") % 5).cast("string")
    return (
        F.when(k == 0, F.concat(a, F.lit(" – "), b, F.lit(" years of work experience.")))
        .when(k == 1, F.concat(F.lit("Under "), a, F.lit(" years")))
        .when(k == 2, F.concat(F.lit("Tối thiểu "), a, F.lit(" năm")))
        .otherwise(F.concat((F.col("p_size") % 24).cast("string"), F.lit(" tháng kinh nghiệm")))
    )


@query("""WITH b AS (SELECT p_partkey, CAST(p_size % 9 AS DOUBLE) AS low, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size % 9 + p_partkey % 5 AS DOUBLE) END AS high FROM part)
          SELECT p_partkey, CASE WHEN high IS NULL THEN CASE WHEN low < 1 THEN 'Fresher' WHEN low < 3 THEN 'Junior' WHEN low < 5 THEN 'Mid-level' ELSE 'Senior' END ELSE
            CASE WHEN (low < 1)::INT + (low < 3 AND high >= 1)::INT + (low < 5 AND high >= 3)::INT + (high >= 5)::INT > 2 THEN '' ELSE
              array_to_string(list_filter([CASE WHEN low < 1 THEN 'Fresher' END, CASE WHEN low < 3 AND high >= 1 THEN 'Junior' END, CASE WHEN low < 5 AND high >= 3 THEN 'Mid-level' END,
                CASE WHEN high >= 5 THEN 'Senior' END], lambda x: x IS NOT NULL), '|') END END AS levels FROM b""")
def experience_level(spark, d):
    low = (F.col("p_size") % 9).cast("double")
    high = F.when(F.col("p_partkey") % 2 == 0, low + F.col("p_partkey") % 5)
    levels = rules.experience_levels(low, high, F.when(high.isNull(), "minimum").otherwise("range"))
    return t(spark, d, "part").select("p_partkey", F.array_join(levels, "|").alias("levels"))


@query("""WITH a AS (SELECT o_orderkey, o_orderkey % 5 AS k, CAST(10 + o_orderkey % 40 AS DOUBLE) AS x FROM orders)
          SELECT o_orderkey, CASE k WHEN 0 THEN x * 1e6 WHEN 1 THEN NULL WHEN 2 THEN x * 1000 WHEN 3 THEN NULL END::DOUBLE AS low,
            CASE k WHEN 0 THEN (x + 10) * 1e6 WHEN 1 THEN x * 100 WHEN 2 THEN NULL END::DOUBLE AS high,
            CASE k WHEN 0 THEN 'VND' WHEN 1 THEN 'USD' WHEN 2 THEN 'USD' END AS currency, CASE k WHEN 0 THEN 'month' WHEN 2 THEN 'year' END AS period,
            CASE k WHEN 0 THEN 'disclosed' WHEN 1 THEN 'disclosed' WHEN 2 THEN 'disclosed' WHEN 3 THEN 'negotiable' ELSE 'not_disclosed' END AS status FROM a""")
def salary_parse(spark, d):
    k, x = F.col("o_orderkey") % 5, 10 + F.col("o_orderkey") % 40
    text = (
        F.when(k == 0, F.concat(x.cast("string"), F.lit(" - "), (x + 10).cast("string"), F.lit(" triệu VND/tháng, gross")))
        .when(k == 1, F.concat(F.lit("Up to $"), F.format_number(x * 100, 0)))
        .when(k == 2, F.concat(F.lit("From "), x.cast("string"), F.lit(",000 USD per year")))
        .when(k == 3, F.lit("Thoả thuận"))
    )
    return t(spark, d, "orders").select("o_orderkey", rules.salary(text).alias("s")).select("o_orderkey", "s.low", "s.high", "s.currency", "s.period", "s.status")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Junior' WHEN o_orderpriority = '1-URGENT' THEN 'Senior' WHEN o_orderpriority = '2-HIGH' THEN 'Lead' ELSE 'Mid-level' END AS level,
            CASE WHEN o_orderkey % 3 = 0 THEN 'source' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'title' ELSE 'experience' END AS source,
            CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS n_conflicts FROM orders""")
def seniority_precedence(spark, d):
    declared = F.when(F.col("o_orderkey") % 3 == 0, rules.declared_levels(F.array(F.lit("Jr.")))).otherwise(F.array().cast("array<string>"))
    title = F.when(F.col("o_orderpriority") == "1-URGENT", "Senior Engineer").when(F.col("o_orderpriority") == "2-HIGH", "Senior Team Lead").otherwise("Engineer")
    found = rules.seniority(declared, title, F.array(F.lit("Mid-level")))
    return t(spark, d, "orders").select("o_orderkey", F.array_join(found["levels"], "|").alias("level"), found["source"].alias("source"), F.size(found["conflicts"]).alias("n_conflicts"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'remote' WHEN o_orderkey % 4 = 1 THEN 'hybrid' WHEN o_orderkey % 4 = 2 THEN 'onsite' END AS mode FROM orders""")
def work_mode(spark, d):
    k = F.col("o_orderkey") % 4
    explicit = F.when(k == 0, "Fully remote").when(k == 1, "Hybrid")
    body = F.when(k == 2, "You work at office.").when(k == 3, "hybrid cloud for remote users").otherwise("work from home")
    return t(spark, d, "orders").select("o_orderkey", rules.work_mode(explicit, body).alias("mode"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'Japanese' WHEN 2 THEN 'English' ELSE 'unknown' END AS language,
            CASE c_custkey % 4 WHEN 0 THEN 'TOEIC 650' WHEN 1 THEN 'JLPT N2' WHEN 2 THEN 'Intermediate English' END AS level_text FROM customer""")
def foreign_language_level(spark, d):
    k = F.col("c_custkey") % 4
    text = F.when(k == 0, "English TOEIC 650 required.").when(k == 1, "JLPT  N2 is a plus").when(k == 2, "Intermediate English").otherwise("none")
    found = F.get(rules.foreign_languages(text), 0)
    return t(spark, d, "customer").select("c_custkey", found["language"].alias("language"), found["level_text"].alias("level_text"))


@query("SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\\s+', ' ', 'g')) AS title FROM pages")
def html_title(spark, d):
    return t(spark, d, "pages").select("page_id", F.trim(F.regexp_replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), r"\s+", " ")).alias("title"))


#: Text of a page in SQL: silent parts out, blocks and breaks to new lines, list items marked, references read (these four count without their semicolon too, as HTML has it), lines cleaned, punctuation closed up.
RICH_TEXT_SQL = r"""WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<!doctype[^>]*>|<script\b.*?</script>|<style\b.*?</style>', '', 'g') AS h FROM pages),
  b AS (SELECT page_id, regexp_replace(regexp_replace(h, '(?i)<li\b[^>]*>', chr(10) || '- ', 'g'), '(?i)</?(p|div|section|h[1-6]|ul|ol|blockquote|tr|li|br|article|body|html|nav)\b[^>]*>', chr(10), 'g') AS h FROM a),
  c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS h FROM b),
  d AS (SELECT page_id, array_to_string(list_filter(list_transform(string_split(h, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS h FROM c)
  SELECT page_id, regexp_replace(regexp_replace(h, '[ \t]+([,;:!?)\]])', '\1', 'g'), '([(\[])[ \t]+', '\1', 'g') AS text FROM d"""


@query(RICH_TEXT_SQL)
def rich_text(spark, d):
    return t(spark, d, "pages").select("page_id", pages.readable("html").alias("text"))


@query("""SELECT page_id, json AS json_ld FROM pages, (VALUES (1), (2)) AS v(n), LATERAL (SELECT '{"@type": "' || CASE n WHEN 1 THEN 'JobPosting' ELSE 'Organization' END || '", "identifier": ' || page_id || '}' AS json) WHERE n = 1 OR page_id % 2 = 0""")
def json_ld_extract(spark, d):
    """Data blocks added to the given pages: one object or a graph of two, and a broken block that is passed over."""
    number = F.col("page_id").cast("string")
    posting, maker = (F.concat(F.lit('{"@type":"' + kind + '","identifier":'), number, F.lit("}")) for kind in ("JobPosting", "Organization"))
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    one = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('{"@graph":['), posting, F.lit(","), maker, F.lit("]}"))).otherwise(posting)
    added = F.concat(block(F.lit("{broken")), block(one), F.coalesce("html", F.lit("")))
    return t(spark, d, "pages").select("page_id", F.explode(html.json_ld(added)).alias("json_ld"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '<a [^>]*href=\"([^\"]+)\"', 1)) AS BIGINT) AS n_links FROM pages")
def page_links(spark, d):
    return t(spark, d, "pages").select("page_id", F.size(html.links("html")).cast("long").alias("n_links"))
