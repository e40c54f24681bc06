"""Preference formatting: a chosen and a rejected conversation become one prompt and two masked completions.

The longest common prefix of turns (same role and text, in turn order) is rendered once as the prompt; what follows is
rendered for each side as segments (text, train), where only the body of assistant turns is trained on. Everything is
DataFrame functions over one grouping by pair; a conversation is one row by its nature.

Defined results: turns are ordered by turn (nulls first), then role and text, so repeated rows follow each other and
count as turns of their own; a null role or text is empty; rows without a conversation id are ignored; a pair that lacks
one side is not emitted; equal conversations give empty completions. Texts of any length are rendered whole; columns other
than conv_id, turn, role and text don't enter. An empty table gives an empty result. The marker `<|` inside a text becomes
`< |`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    """Turns as text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def segments(turns: Column) -> Column:
    """Turns as array<struct<text, train>>: a header and a body for each."""
    pair = lambda t: F.array(
        F.struct(_header(t).alias("text"), F.lit(False).alias("train")), F.struct(_body(t).alias("text"), (t["role"] == TRAINED_ROLE).alias("train"))
    )
    return F.flatten(F.transform(turns, pair))


def trained_text(found: Column) -> Column:
    return F.array_join(F.transform(F.filter(found, lambda s: s["train"]), lambda s: s["text"]), "")


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row for each pair, from (pair_id, side, conv_id, turn, role, text) rows; side is 'chosen' or 'rejected'."""
    safe = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|"), F.lit("< |"))
    turn = F.struct(F.col("turn").alias("turn"), safe("role").alias("role"), safe("text").alias("text"))
    side = lambda name: F.sort_array(F.collect_list(F.when(F.col("side") == name, turn)))
    one = lambda name: F.max(F.when(F.col("side") == name, F.col("conv_id")))
    rows = turns.where(F.col("pair_id").isNotNull() & F.col("side").isNotNull())
    grouped = rows.groupBy("pair_id").agg(side("chosen").alias("_c"), side("rejected").alias("_r"), one("chosen").alias("chosen_id"), one("rejected").alias("rejected_id"))
    both = grouped.where((F.size("_c") > 0) & (F.size("_r") > 0)).withColumn("_most", F.least(F.size("_c"), F.size("_r")))
    differs = lambda i: (F.element_at("_c", i)["role"] != F.element_at("_r", i)["role"]) | (F.element_at("_c", i)["text"] != F.element_at("_r", i)["text"])
    first = F.array_min(F.filter(F.sequence(F.lit(1), F.col("_most")), differs))
    both = both.withColumn("prompt_turns", F.coalesce(first - 1, F.col("_most")))
    tail = lambda c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c) - F.col("prompt_turns"), F.lit(0)))
    parts = both.withColumns({"_prompt": F.slice("_c", 1, F.col("prompt_turns")), "_ct": tail("_c"), "_rt": tail("_r")})
    return parts.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("prompt_turns").cast("long").alias("prompt_turns"),
        render(F.col("_prompt")).alias("prompt"),
        segments(F.col("_ct")).alias("chosen"),
        segments(F.col("_rt")).alias("rejected"),
    )


def neighbours(conversations: DataFrame) -> DataFrame:
    """Turns dealt into pairs: conversation 2k is the chosen, 2k + 1 the rejected side of pair k."""
    odd = F.pmod("conv_id", F.lit(2))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.floor((F.col("conv_id") - odd) / 2).cast("long").alias("pair_id"), F.when(odd == 0, "chosen").otherwise("rejected").alias("side"), "conv_id", "turn", "role", "text"
    )


ORACLE_SQL = """
WITH t AS (
  SELECT conv_id - conv_id % 2 AS base, conv_id % 2 AS odd, conv_id, turn,
         replace(coalesce(role, ''), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM t),
sizes AS (
  SELECT base, max(CASE WHEN odd = 0 THEN k END) AS nc, max(CASE WHEN odd = 1 THEN k END) AS nr FROM n GROUP BY base),
p AS (SELECT * FROM sizes WHERE nc IS NOT NULL AND nr IS NOT NULL),
miss AS (
  SELECT c.base, min(c.k) AS k FROM n c JOIN n r ON c.base = r.base AND c.k = r.k AND c.odd = 0 AND r.odd = 1
  WHERE c.role <> r.role OR c.text <> r.text GROUP BY c.base),
l AS (SELECT p.base, coalesce(miss.k - 1, least(nc, nr)) AS lcp FROM p LEFT JOIN miss USING (base)),
r AS (SELECT n.base, odd, k, lcp, role, '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body FROM n JOIN l USING (base))
SELECT CAST(base // 2 AS BIGINT) AS pair_id, base AS chosen_id, base + 1 AS rejected_id, CAST(max(lcp) AS BIGINT) AS prompt_turns,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (odd = 0 AND k <= lcp), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (odd = 0 AND k > lcp), '') AS chosen_text,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (odd = 1 AND k > lcp), '') AS rejected_text,
  coalesce(string_agg(body, '' ORDER BY k) FILTER (odd = 0 AND k > lcp AND role = 'assistant'), '') AS chosen_trained,
  coalesce(string_agg(body, '' ORDER BY k) FILTER (odd = 1 AND k > lcp AND role = 'assistant'), '') AS rejected_trained
FROM r GROUP BY base
"""
