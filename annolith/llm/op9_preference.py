"""Preference formatting with DataFrame expressions alone: shared prompt, paired completions, masks of what is trained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    """Turns (role, text) as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def mask(turns: Column) -> Column:
    """As long as the rendered turns: 1 for each character of an assistant's text and its close, else 0."""

    def one(t: Column) -> Column:
        head, rest = F.length(_head(t)), F.length(t["text"]) + len(CLOSE)
        return F.concat(F.repeat(F.lit("0"), head), F.repeat(F.when(t["role"] == "assistant", "1").otherwise("0"), rest))

    return F.array_join(F.transform(turns, one), "")


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    same = F.zip_with(chosen, rejected, lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(chosen)).cast("int")


def format_preferences(pairs: DataFrame, *, id_col: str = "pair_id", chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """``id_col, common, prompt, chosen, rejected, chosen_mask, rejected_mask`` of each pair of arrays of (role, text).

    The longest common turn prefix is rendered once, as ``prompt``; what follows of each side is its completion. A null role
    counts as ``user``, a null text and a null turn as empty, a null side as no turns. Equal sides have empty completions, sides without a common turn an
    empty prompt. Every row gives one row; an empty table none; other columns are not kept.
    """

    def clean(c: str) -> Column:
        turns = F.coalesce(F.col(c), F.array().cast("array<struct<role:string,text:string>>"))
        return F.transform(turns, lambda t: F.struct(F.coalesce(t["role"], F.lit("user")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))

    rows = pairs.select(F.col(id_col).alias("_id"), clean(chosen_col).alias("_c"), clean(rejected_col).alias("_r"))
    rows = rows.withColumn("_n", common_turns(F.col("_c"), F.col("_r")))
    after = {s: F.slice(F.col(s), F.col("_n") + 1, F.greatest(F.size(s) - F.col("_n"), F.lit(0))) for s in ("_c", "_r")}
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("common"),
        render(F.slice("_c", F.lit(1), F.col("_n"))).alias("prompt"),
        render(after["_c"]).alias("chosen"),
        render(after["_r"]).alias("rejected"),
        mask(after["_c"]).alias("chosen_mask"),
        mask(after["_r"]).alias("rejected_mask"),
    )


def swapped_pairs(conversations: DataFrame) -> DataFrame:
    """``pair_id, chosen, rejected``: each conversation, and itself with its last answer swapped for its neighbour's.

    Neighbours are the ids 2 k and 2 k + 1, so a group holds two conversations, whatever texts they share. Without a neighbour or an answer
    there, the rejected answer is empty; without an answer of its own, a conversation's sides are equal. Rows with a null conv_id belong to no conversation and
    are left out; turns are ordered by (turn, role, text), null turns first; repeated turns are kept.
    """
    rows = conversations.where("conv_id is not null").groupBy(F.floor(F.col("conv_id") / 2).alias("k"))
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("conv_id", "turn", "role", "text"))).alias("all"))
    turn = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    sides = rows.select("all", F.explode(F.array_distinct(F.transform("all", lambda t: t["conv_id"]))).alias("pair_id"))
    sides = sides.select(
        "pair_id",
        F.transform(F.filter("all", lambda t: t["conv_id"] == F.col("pair_id")), turn).alias("chosen"),
        F.filter("all", lambda t: (t["conv_id"] != F.col("pair_id")) & (t["role"] == "assistant")).alias("others"),
    )
    answers = F.transform("chosen", lambda t, i: F.when(t["role"] == "assistant", i).otherwise(-1))
    sides = sides.withColumn("last", F.array_max(answers)).withColumn("swap", F.coalesce(F.try_element_at("others", F.lit(-1))["text"], F.lit("")))
    swap = F.transform("chosen", lambda t, i: F.struct(t["role"].alias("role"), F.when(i == F.col("last"), F.col("swap")).otherwise(t["text"]).alias("text")))
    return sides.select("pair_id", "chosen", swap.alias("rejected"))


def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_preferences(swapped_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {"op9_preference_format": op9_preference_format}
SQL = {
    "op9_preference_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(n) AS n FROM t WHERE role = 'assistant' GROUP BY conv_id),
answer AS (SELECT t.conv_id, t.text FROM t JOIN last USING (conv_id, n)),
swapped AS (SELECT t.conv_id, t.n, t.role, t.text AS c, CASE WHEN t.n = last.n THEN coalesce(answer.text, '') ELSE t.text END AS r
  FROM t LEFT JOIN last ON last.conv_id = t.conv_id LEFT JOIN answer ON answer.conv_id = xor(t.conv_id, 1)),
cut AS (SELECT conv_id, coalesce(min(n) FILTER (WHERE c <> r), max(n) + 1) - 1 AS common FROM swapped GROUP BY conv_id),
line AS (SELECT swapped.*, common, '<|im_start|>' || role || chr(10) AS head, '<|im_end|>' || chr(10) AS tail,
  CASE WHEN role = 'assistant' THEN '1' ELSE '0' END AS bit FROM swapped JOIN cut USING (conv_id))
SELECT conv_id AS pair_id, CAST(any_value(common) AS INTEGER) AS common,
  coalesce(string_agg(head || c || tail, '' ORDER BY n) FILTER (WHERE n <= common), '') AS prompt,
  coalesce(string_agg(head || c || tail, '' ORDER BY n) FILTER (WHERE n > common), '') AS chosen,
  coalesce(string_agg(head || r || tail, '' ORDER BY n) FILTER (WHERE n > common), '') AS rejected,
  coalesce(string_agg(repeat('0', length(head)) || repeat(bit, length(c) + 11), '' ORDER BY n) FILTER (WHERE n > common), '') AS chosen_mask,
  coalesce(string_agg(repeat('0', length(head)) || repeat(bit, length(r) + 11), '' ORDER BY n) FILTER (WHERE n > common), '') AS rejected_mask
FROM line GROUP BY conv_id
"""
}
