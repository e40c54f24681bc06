"""Text Column functions: whitespace, folding to plain ASCII, keys, URLs and identities. All of them stay in the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once for each row, however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def quoted(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup_map(names: dict[str, str]) -> Column:
    """A small dictionary as a literal map."""
    return F.expr("map(" + ", ".join(quoted(x) for pair in names.items() for x in pair) + ")")


def _collapsed(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"(?U)\s+", " "))


def clean_text(value: Column | str) -> Column:
    """Collapse Unicode white space, trim; empty becomes null."""
    return F.nullif(_collapsed(_col(value)), F.lit(""))


def clean_items(values: Column) -> Column:
    """The texts of a list as clean_text gives them, without nulls. Each is worked out once, where nullif inside a lambda takes two."""
    return F.filter(F.transform(values, _collapsed), lambda x: x != "")


def clean_once(value: Column) -> Column:
    """clean_text of a value that costs something, for use inside lambdas."""
    return F.get(clean_items(F.array(value)), 0)


@cache
def _fold_table() -> tuple[str, str]:
    """Characters below U+10000 whose compatibility decomposition, without marks, is a single ASCII character."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        char = chr(code)
        if unicodedata.category(char) in ("Cs", "Mn", "Mc", "Me"):
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char.casefold()) if not unicodedata.combining(c))
        plain = "d" if char in "đĐ" else plain
        if len(plain) == 1 and ord(plain) < 0x80 and plain != char:
            source.append(char)
            target.append(plain)
    return "".join(source), "".join(target)


def strip_marks(value: Column | str) -> Column:
    """Lower case without accents; letters with longer decompositions (ligatures, fractions) stay as they are."""
    source, target = _fold_table()
    marked = lambda x: F.regexp_replace(F.translate(F.replace(F.lower(x), F.lit("ß"), F.lit("ss")), source, target), r"\p{M}+", "")
    # a text of ASCII characters alone has no marks to look for
    return let(F.coalesce(_col(value), F.lit("")), lambda x: F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(marked(x)))


def fold(value: Column | str) -> Column:
    """Comparison form: lower case, no accents, every run outside [a-z0-9+#.] one blank."""
    return F.trim(F.regexp_replace(strip_marks(value), r"[^a-z0-9+#.]+", " "))


def fold_plain(value: Column | str) -> Column:
    """Token form for phrase search: technology names with signs become words first, then only [a-z0-9] stays."""
    out = strip_marks(value)
    for sign, word in SIGN_WORDS:
        out = F.replace(out, F.lit(sign), F.lit(word))
    return F.trim(F.regexp_replace(out, r"[^a-z0-9]+", " "))


#: Names that lose their meaning without their signs.
SIGN_WORDS = (("c++", "cplusplus"), ("c#", "csharp"), (".net", "dotnet"), ("node.js", "nodejs"), ("react.js", "reactjs"))


def fold_pattern(value: Column | str) -> Column:
    """Form for number patterns: dashes unified, [a-z0-9+.,-] kept."""
    dashes = F.translate(strip_marks(value), "–—", "--")
    return F.trim(F.regexp_replace(dashes, r"[^a-z0-9+.,-]+", " "))


def natural_key(value: Column | str) -> Column:
    return F.lower(F.trim(_col(value)))


def label_key(value: Column | str) -> Column:
    return F.lower(clean_text(value))


def has_phrase(folded: Column, phrase: Column | str) -> Column:
    """Whether a folded text holds a phrase as whole tokens."""
    phrase = F.lit(phrase) if isinstance(phrase, str) else phrase
    return F.contains(F.concat(F.lit(" "), folded, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def _shortened(v: Column, most: int = 240) -> Column:
    return F.when(F.length(v) > most, F.concat(F.rtrim(F.substring(v, 1, most - 1)), F.lit("…"))).otherwise(v)


def short_evidence(value: Column | str, most: int = 240) -> Column:
    return _shortened(clean_text(value), most)


def short_items(values: Column) -> Column:
    """The texts of a list as short_evidence gives them, without nulls, each once without regard to case."""
    return distinct_ignoring_case(F.transform(clean_items(values), lambda x: _shortened(x)))


def canonical_url(value: Column | str) -> Column:
    """scheme://host/path of an http(s) address: lower-case scheme and host, no port, user, query, fragment or last slash."""
    url = F.trim(_col(value))
    scheme = F.lower(F.regexp_extract(url, r"(?i)^(https?)://", 1))
    host = F.lower(F.regexp_extract(url, r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"(?i)^https?://[^/?#]*([^?#]*)", 1), r"/+$", "")
    return F.when((scheme != "") & (host != ""), F.concat(scheme, F.lit("://"), host, path))


def id_after_source(value: Column | str) -> Column:
    """The part of 'source:id' after the first colon; the whole without one."""
    return F.regexp_replace(_col(value), "^[^:]*:", "")


def observation_id(job_id: Column | str, run_id: Column | str) -> Column:
    """Upper-case SHA-256 of 'job|run' in UTF-16LE."""
    return F.upper(F.sha2(F.encode(F.concat(_col(job_id), F.lit("|"), _col(run_id)), "UTF-16LE"), 256))


def json_digest(*values: Column | str) -> Column:
    """Lower-case SHA-256 of the compact JSON array of the values."""
    return F.sha2(F.to_json(F.array(*[_col(v) for v in values]), {"ignoreNullFields": "false"}), 256)


def packed_digest(value: Column | str) -> Column:
    """The bytes of a lower-case SHA-256, half as long as its digits; other texts keep apart behind a mark."""
    digits = _col(value)
    return F.when(digits.rlike("^[0-9a-f]{64}$"), F.unhex(digits)).otherwise(F.concat(F.lit("text:"), digits).cast("binary"))


def split_values(value: Column | str) -> Column:
    """Parts of a list written as text, cleaned, each once (without regard to case), in order of appearance."""
    parts = F.filter(F.transform(F.split(F.coalesce(_col(value), F.lit("")), r"[,;|\n]"), clean_text), lambda x: x.isNotNull())
    return distinct_ignoring_case(parts)


def distinct_ignoring_case(values: Column) -> Column:
    start = F.array().cast("array<string>")
    several = lambda v: F.aggregate(v, start, lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))
    return let(values, lambda v: F.when(F.size(v) > 1, several(v)).otherwise(v))


def tree_pattern(words: list[str]) -> str:
    """A pattern of all words: what they begin with in common stands once, and longer ones are tried before shorter ones."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        if word:
            by_first.setdefault(word[0], []).append(word[1:])
    branches = [(first if first.isalnum() or first == " " else f"\\{first}") + tree_pattern(rest) for first, rest in sorted(by_first.items())]
    ends = "" in words
    body = "(?:" + "|".join(branches) + ")" if len(branches) > 1 or (branches and ends) else "".join(branches)
    return body + "?" if body and ends else body
