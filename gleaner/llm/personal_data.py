"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby move the score.

Each kind has a pattern, a score to begin with, a check and words that speak for or against it. The four base kinds keep
every match that passes its check. Beyond them the method adds, where the score reaches `THRESHOLD`: IBANs (mod-97), social
security numbers, cards that stand inside a longer run of digits (Luhn), and national phone numbers; these last three need a
word nearby that speaks for them. Work is done text by text in Arrow batches: no shuffle at any size.

Every scan is linear in the text, whatever it holds: addresses are found from their @ sign outward, and patterns over
digits never step back into what they have read.

Defined results: a null or empty text has no spans. A text of any length is searched whole. Offsets are code points, ends
exclusive. Repeated rows are judged alike, each for itself. `find` keeps the input columns and replaces one that is named
like its output. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructType

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
SPAN = StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType()).add("score", DoubleType()).add("base", BooleanType())
THRESHOLD = 0.6
CHECKED, NEAR, AGAINST = 0.3, 0.3, 0.3
#: Code points before and after a span that count as near.
BEFORE, AFTER = 48, 24

#: Words near a span that speak for its kind, and words that speak against any kind.
CONTEXT = {
    "email": "email mail e-mail contact write correo courriel kontakt",
    "ip": "ip address host server adresse",
    "card": "card credit visa mastercard amex debit karte carte tarjeta payment",
    "phone": "phone tel telephone call mobile cell fax telefon téléphone teléfono handy",
    "iban": "iban bank account konto compte cuenta transfer bic",
    "ssn": "ssn social security taxpayer",
}
AGAINST_WORDS = frozenset("version isbn issn build serial order invoice part commit revision example".split())
CONTEXT_WORDS = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}
#: The score of a match of each kind's pattern, before its checksum and context.
PRIOR = {"email": 0.6, "ip": 0.4, "card": 0.3, "phone": 0.4, "iban": 0.4, "ssn": 0.3}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_BACKWARD = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_GROUP = re.compile(r"[0-9]++")
_NEAR_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def luhn(digits: str) -> bool:
    """Whether a string of digits has a right Luhn check digit."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether letters and digits pass the check of ISO 7064 mod 97-10, their first four moved to the end."""
    value = 0
    for c in iban[4:] + iban[:4]:
        n = int(c, 36)
        value = (value * (100 if n > 9 else 10) + n) % 97
    return value == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: a match can only begin at the first character of the run before an @ sign."""
    end, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        # At most the characters since the last @ or match are turned round, so all runs together are one pass.
        local = domain and _LOCAL_BACKWARD.match(text[end:at][::-1])
        if local:
            yield at - local.end(), domain.end()
            end = domain.end()
        else:
            end = at + 1
        at = text.find("@", end)


def _ip_ok(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))


def _card_ok(match: str) -> bool:
    digits = digits_of(match)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(match: str) -> bool:
    return 9 <= len(digits_of(match)) <= 15


def _ssn_ok(match: str) -> bool:
    area, group, serial = match.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def _matches(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in pattern.finditer(text))


def _score(text: str, kind: str, start: int, end: int, checked: bool) -> tuple[float, bool]:
    """The score of a span, and whether a word nearby speaks for its kind."""
    near = {w.lower() for part in (text[max(0, start - BEFORE) : start], text[end : end + AFTER]) for w in _NEAR_WORD.findall(part)}
    spoken = bool(near & CONTEXT_WORDS[kind])
    score = PRIOR[kind] + CHECKED * checked + NEAR * spoken - AGAINST * bool(near & AGAINST_WORDS)
    return round(min(1.0, max(0.0, score)), 3), spoken


#: Base kinds: how matches are found, and what a match must pass.
BASE: dict[str, tuple[Callable[[str], Iterator[tuple[int, int]]], Callable[[str], bool]]] = {
    "email": (_emails, lambda m: True),
    "ip": (lambda text: _matches(_IP, text), _ip_ok),
    "card": (lambda text: _matches(_CARD, text), _card_ok),
    "phone": (lambda text: _matches(_PHONE, text), _phone_ok),
}


def _proposals(text: str, failed_cards: list[tuple[int, int]]) -> Iterator[tuple[str, int, int, bool, bool]]:
    """(kind, start, end, checked, needs a word nearby) of the added kinds."""
    for start, end in _matches(_IBAN, text):
        # What follows a blank may be the next word: the longest cut at a blank that passes counts.
        cuts = [end, *(i for i in range(end - 1, start + 14, -1) if text[i] == " ")]
        stop = next((c for c in cuts if mod97(text[start:c].replace(" ", ""))), None)
        if stop:
            yield "iban", start, stop, True, False
    for start, end in _matches(_SSN, text):
        if _ssn_ok(text[start:end]):
            yield "ssn", start, end, False, True
    for begin, stop in failed_cards:
        for group in _GROUP.finditer(text, begin, stop):
            if _card_ok(group[0]):
                yield "card", *group.span(), True, True
    for start, end in _matches(_NATIONAL, text):
        yield "phone", start, end, False, True


def spans_of(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) of one text, by kind and start."""
    if not text:
        return []
    found, failed_cards = [], []
    for kind, (search, passes) in BASE.items():
        for start, end in search(text):
            if passes(text[start:end]):
                found.append((kind, start, end, _score(text, kind, start, end, kind == "card")[0], True))
            elif kind == "card":
                failed_cards.append((start, end))
    added = []
    for kind, start, end, checked, needs_word in _proposals(text, failed_cards):
        score, spoken = _score(text, kind, start, end, checked)
        if score >= THRESHOLD and (spoken or not needs_word):
            added.append((kind, start, end, score, False))
    return sorted(found + _clear_of(added, found, len(text)), key=lambda s: (KINDS.index(s[0]), s[1]))


def _clear_of(added: list[tuple], base: list[tuple], length: int) -> list[tuple]:
    """Added spans that overlap no base span and no added one with a higher score (of equal ones, that which begins first)."""
    if not added:
        return []
    kept, claimed = [], bytearray(length)
    for span in base:
        claimed[span[1] : span[2]] = b"\1" * (span[2] - span[1])
    for span in sorted(added, key=lambda s: (-s[3], s[1], s[2])):
        if not any(claimed[span[1] : span[2]]):
            kept.append(span)
            claimed[span[1] : span[2]] = b"\1" * (span[2] - span[1])
    return kept


@F.pandas_udf(ArrayType(SPAN))
def _spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [dict(zip(SPAN.names, s, strict=True)) for s in spans_of(t)])


def find(docs: DataFrame, text: str = "text", output: str = "spans") -> DataFrame:
    """docs with an array of (kind, start, end, score, base), by kind and start."""
    return docs.withColumn(output, _spans(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of each document: n_<kind> of the base spans, base_sha256, all spans, and how many were added."""
    found = find(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text")), "_text", "_spans")
    base = F.filter("_spans", lambda s: s["base"])
    counts = [_count(base, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    added = F.size(F.filter("_spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"), added)
