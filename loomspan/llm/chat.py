"""Preference formatting: pairs of conversations become one prompt and two masked completions.

The prompt is the longest run of turns that both conversations begin with, rendered once. What follows in each is
its completion, rendered turn by turn with a mask: 1 for turns of the trained role, 0 for the rest.

Defined results: null roles and texts are empty; null turns come first; equal turn numbers go by role, then text;
repeated rows are turns of their own; rows with a null conv_id and pairs that lack a conversation give nothing; if
one conversation begins with the whole other, the shorter one's completion is empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as an array of (turn, role, text)."""
    turn = F.struct(
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))  # one conversation


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs for tables without preference labels: conversation 2k is chosen over 2k + 1."""
    even = turns.where(F.pmod("conv_id", F.lit(2)) == 0).select(F.col("conv_id").cast("long").alias("chosen_id")).distinct()
    return even.select(F.expr("chosen_id div 2").alias("pair_id"), "chosen_id", (F.col("chosen_id") + 1).alias("rejected_id"))


def _rendered(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n")))


def _mask(turns: Column, trained: str) -> Column:
    """flag:characters of each rendered turn, comma-joined."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.when(t["role"] == trained, F.lit("1:")).otherwise(F.lit("0:")), (F.length(t["role"]) + F.length(t["text"]) + 13).cast("string"))),
        ",",
    )


def preference_pairs(turns: DataFrame, pairs: DataFrame, trained: str = "assistant") -> DataFrame:
    """pair_id, chosen_id, rejected_id, prompt_turns, prompt, chosen, chosen_mask, rejected and rejected_mask."""
    held = conversations(turns)
    rows = pairs.select("pair_id", "chosen_id", "rejected_id")
    for k in ("chosen", "rejected"):
        rows = rows.join(held.select(F.col("conv_id").alias(f"{k}_id"), F.col("turns").alias(f"{k}_turns")), f"{k}_id")
    least = F.least(F.size("chosen_turns"), F.size("rejected_turns"))
    same = F.zip_with(
        F.slice("chosen_turns", 1, least), F.slice("rejected_turns", 1, least),
        lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]),
    )
    differs = F.array_position(same, False)
    rows = rows.withColumn("prompt_turns", F.when(differs == 0, least).otherwise(differs - 1).cast("long"))

    def after(c: str) -> Column:
        return F.slice(c, F.col("prompt_turns").cast("int") + 1, F.greatest(F.size(c) - F.col("prompt_turns").cast("int"), F.lit(0)))

    prompt = F.slice("chosen_turns", 1, F.col("prompt_turns").cast("int"))
    return rows.select(
        "pair_id", "chosen_id", "rejected_id", "prompt_turns", F.array_join(_rendered(prompt), "").alias("prompt"),
        F.array_join(_rendered(after("chosen_turns")), "").alias("chosen"), _mask(after("chosen_turns"), trained).alias("chosen_mask"),
        F.array_join(_rendered(after("rejected_turns")), "").alias("rejected"), _mask(after("rejected_turns"), trained).alias("rejected_mask"),
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn, role, text) AS turns FROM t GROUP BY conv_id),
p AS (
  SELECT a.conv_id // 2 AS pair_id, a.conv_id AS chosen_id, b.conv_id AS rejected_id, a.turns AS ct, b.turns AS rt,
         least(len(a.turns), len(b.turns)) AS n
  FROM c a JOIN c b ON b.conv_id = a.conv_id + 1 WHERE a.conv_id % 2 = 0),
q AS (
  SELECT *, coalesce(list_min(list_filter(range(1, n + 1), lambda i: ct[i].role <> rt[i].role OR ct[i].text <> rt[i].text)) - 1, n) AS k FROM p),
r AS (SELECT *, ct[1:k] AS pt, ct[k + 1:] AS cc, rt[k + 1:] AS rc FROM q)
SELECT CAST(pair_id AS BIGINT) AS pair_id, chosen_id, rejected_id, CAST(k AS BIGINT) AS prompt_turns,
  array_to_string(list_transform(pt, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') AS prompt,
  array_to_string(list_transform(cc, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') AS chosen,
  array_to_string(list_transform(cc, lambda x: CASE WHEN x.role = 'assistant' THEN '1:' ELSE '0:' END || (length(x.role) + length(x.text) + 13)), ',') AS chosen_mask,
  array_to_string(list_transform(rc, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') AS rejected,
  array_to_string(list_transform(rc, lambda x: CASE WHEN x.role = 'assistant' THEN '1:' ELSE '0:' END || (length(x.role) + length(x.text) + 13)), ',') AS rejected_mask
FROM r
"""
