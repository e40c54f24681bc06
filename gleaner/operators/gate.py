"""Role gate: which catalogue roles a posting names, and what becomes of it. Rejects are data, not errors."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import fold_plain, let, quoted, tree_pattern

MATCHED = "matched_role_keyword"


def has_word(text: Column) -> Column:
    return fold_plain(text) != ""


def catalogue(roles: dict[str, tuple[str, ...]]) -> Column:
    """A role catalogue as a literal map: from every phrase to the array<struct<at, role, keyword>> of the keywords that it begins with; `at`
    numbers all keywords, the longest first."""
    pairs = sorted(((r, k) for r, keywords in roles.items() for k in keywords), key=lambda p: (-len(p[1]), p[1], p[0]))
    begun: dict[str, list[str]] = {k: [] for _, k in pairs}
    for at, (role, keyword) in enumerate(pairs):
        for phrase, held in begun.items():
            if f"{phrase} ".startswith(f"{keyword} "):
                held.append(f"named_struct('at', {at}, 'role', {quoted(role)}, 'keyword', {quoted(keyword)})")
    return F.expr("map(" + ", ".join(f"{quoted(phrase)}, array({', '.join(held)})" for phrase, held in begun.items()) + ")")


def phrases_in(folded: Column, phrases: Iterable[str]) -> Column:
    """array<string>: at every word of a folded text the longest of some folded phrases that begins there, each once. All phrases form
    one tree, so a text is read once for any number of them; matches take the blank before a word alone, so phrases may overlap."""
    phrases = sorted(set(phrases))
    odd = [p for p in phrases if not re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", p)]
    if odd or not phrases:
        raise ValueError(f"phrases must be folded words: {odd}")
    padded = F.concat(F.lit(" "), folded, F.lit(" "))
    return F.array_distinct(F.regexp_extract_all(padded, F.lit(f" (?=({tree_pattern(phrases)}) )"), F.lit(1)))


def role_matches(text: Column, roles: dict[str, tuple[str, ...]]) -> Column:
    """array<struct<role, keyword>>: the longest keyword of every role that a text names as whole tokens.

    Where a phrase begins, every other phrase that begins there is one of its beginnings, so the longest ones tell all."""
    table = catalogue(roles)
    hits = phrases_in(fold_plain(text), {k for keywords in roles.values() for k in keywords})
    named = F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda hit: table[hit]))))
    return F.transform(let(named, _first_of_each), lambda p: F.struct(p["role"].alias("role"), p["keyword"].alias("keyword")))


def _first_of_each(hits: Column) -> Column:
    start = F.filter(hits, lambda p: F.lit(False))
    first_of_role = lambda acc, p: F.when(F.exists(acc, lambda q: q["role"] == p["role"]), acc).otherwise(F.concat(acc, F.array(p)))
    return F.when(F.size(hits) > 1, F.aggregate(hits, start, first_of_role)).otherwise(hits)


def gate(postings: DataFrame, role_text: str, body: str, roles: dict[str, tuple[str, ...]]) -> DataFrame:
    """postings with language, matches, reason and accepted."""
    rows = postings.withColumn("language", rules.posting_language(F.concat_ws("\n", role_text, body))).withColumn("matches", role_matches(F.col(role_text), roles))
    missing = F.coalesce(F.trim(F.col(role_text)), F.lit("")) == ""
    reason = (
        F.when(missing, "missing_role_text")
        .when(F.col("language") == "other", "unsupported_language")
        .when(F.col("language") == "unknown", "unknown_language")
        .when(F.size("matches") > 0, MATCHED)
        .otherwise("no_matching_role_keyword")
    )
    return rows.withColumn("reason", reason).withColumn("accepted", F.col("reason") == MATCHED)
