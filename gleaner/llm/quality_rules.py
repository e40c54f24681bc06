"""Quality rules: a table of thresholds, compiled into Spark projections without user functions.

`metrics` measures every whole text, `compile_rules` turns rows of RULES into one boolean Column and one array
of the names of the rules that failed. All of it is built-in expressions, row by row: no shuffle at any size.

Defined results: a null or empty text has zero words, fails `few_words`, and is not kept; ratios of a text
without words are 0. A text of any length is measured whole. Repeated rows are judged alike, each for itself. Input
columns stay whatever their names; apply_rules replaces those named as one of its own (METRICS and the verdicts), and
keep_good replaces none. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in that is was for with it on be as at by this from or are an a have not "
    "le la les de des un une et est dans pour que qui pas sur avec au du en par "
    "der die das und ist von mit den ein eine nicht zu auf im dem sich für "
    "el los las y una por con para del se su lo es"
).split()

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Keep a text if `metric` (an SQL expression over the metric columns) is within [least, most]."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    base: bool = False


#: The threshold table. `base` marks the rules of the fixed verdict; the others were set loosely, to keep clean text.
RULES = (
    Rule("few_words", "n_words", least=20, base=True),
    Rule("repeated_windows", "100 * n_repeat_words - 30 * n_words", most=0, base=True),
    Rule("word_length_low", "word_chars - 2 * n_words", least=0),
    Rule("word_length_high", "word_chars - 16 * n_words", most=0),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", most=0.3),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", least=0.02),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.5),
)

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def _repeat_words(df: DataFrame, arr: str, out: str) -> DataFrame:
    """Words covered by windows of WINDOW words that occur twice or more.

    Window hashes double in width (1, 2, 4, 8 words), so every word costs a few hash calls. Only texts in which a
    window hash recurs sort their windows.
    """
    n = F.size(arr)
    df = df.withColumn("_h1", F.transform(arr, lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        h, left = F.col(f"_h{width}"), n - (2 * width - 1)
        df = df.withColumn(
            f"_h{2 * width}",
            F.when(left > 0, F.zip_with(F.slice(h, 1, left), F.slice(h, width + 1, left), lambda a, b: F.xxhash64(a, b))),
        )
    df = df.withColumn("_again", F.size(F.array_distinct("_h8")) < F.size("_h8"))
    df = df.withColumn("_sorted", F.when(F.col("_again"), F.sort_array(F.transform("_h8", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    at = lambda k: F.element_at("_sorted", k)
    last = F.size("_sorted")
    df = df.withColumn(
        "_starts",
        F.when(
            F.col("_again"),
            F.sort_array(
                F.transform(
                    F.filter(
                        F.sequence(F.lit(1), last),
                        lambda k: ((k > 1) & (at(F.greatest(k - 1, F.lit(1)))["x"] == at(k)["x"])) | ((k < last) & (at(F.least(k + 1, last))["x"] == at(k)["x"])),
                    ),
                    lambda k: at(k)["i"],
                )
            ),
        ),
    )
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "_starts",
        start,
        lambda acc, p: F.struct((acc["covered"] + WINDOW - F.greatest(F.lit(0), acc["end"] - p)).alias("covered"), (p + WINDOW).alias("end")),
        lambda acc: acc["covered"],
    )
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("_h1", "_h2", "_h4", "_h8", "_again", "_sorted", "_starts")


def _packed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))


def _measured(packed: DataFrame) -> DataFrame:
    """(_row, + the columns of METRICS) from _packed rows."""
    body = F.coalesce(F.col("_text"), F.lit(""))
    df = packed.withColumn("_words", words(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = _repeat_words(df, "_words", "n_repeat_words")
    return df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
        }
    ).select("_row", *METRICS)


def _passes(rule: Rule) -> Column:
    value = F.expr(rule.metric)
    ok = F.lit(True)
    if rule.least is not None:
        ok = ok & (value >= F.lit(rule.least))
    if rule.most is not None:
        ok = ok & (value <= F.lit(rule.most))
    return ok


def compile_rules(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """base_failed, kept and failed_rules as Columns over the metric columns."""
    base = [r for r in rules if r.base]
    base_failed, kept = F.lit(False), F.lit(True)
    for rule in base:
        base_failed = base_failed | ~_passes(rule)
    for rule in rules:
        kept = kept & _passes(rule)
    return {
        "base_failed": base_failed,
        "kept": kept,
        "failed_rules": F.array_compact(F.array(*[F.when(~_passes(r), F.lit(r.name)) for r in rules])),
    }


def apply_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with metrics and verdicts."""
    verdicts = compile_rules(rules)
    own = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in (*METRICS, *verdicts)]
    return _measured(_packed(docs, text)).withColumns(verdicts).select(*own, *METRICS, *verdicts)


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Only the documents that pass every rule, with the columns they came with (clashing names too)."""
    # The row number keeps the optimizer from rebuilding every metric inside the filter, where it would be worked out many times.
    judged = _measured(_packed(docs, text)).withColumns(compile_rules(rules)).withColumn("_at", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_at") >= 0)).select("_row.*")


def _condition(rule: Rule) -> str:
    parts = [f"{rule.metric} >= {rule.least}"] * (rule.least is not None) + [f"{rule.metric} <= {rule.most}"] * (rule.most is not None)
    return "(" + " AND ".join(parts) + ")"


#: The rows of the registered query in DuckDB SQL, compiled from the same threshold table.
ORACLE_SQL = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
  windows AS (SELECT row, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS win FROM (SELECT row, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
  again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) WHERE n > 1),
  covered AS (SELECT row, count(DISTINCT i + j) AS n FROM again, range({WINDOW}) AS r(j) GROUP BY row),
  m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(body, '{SYMBOLS}')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(list_filter(ws, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))}))) AS n_stop_words,
    coalesce(c.n, 0) AS n_repeat_words FROM w LEFT JOIN covered c USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, NOT ({" AND ".join(_condition(r) for r in RULES if r.base)}) AS base_failed,
  {" AND ".join(_condition(r) for r in RULES)} AS kept,
  array_to_string(list_filter([{", ".join(f"CASE WHEN NOT {_condition(r)} THEN '{r.name}' END" for r in RULES)}], lambda x: x IS NOT NULL), ',') AS failed_rules, n_lines, n_stop_words
FROM m
"""
