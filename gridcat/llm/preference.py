"""Preference formatting of chosen and rejected conversations.

Both conversations of a pair share their longest common turn prefix, which is
rendered once as the prompt.  What follows is rendered apart for each side,
with a mask of the spans a model learns from: the assistant's turns, end
mark included.

A conversation meets in one row once, since its rendering is one string; all
that follows is array expressions in that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE_OPEN, ROLE_CLOSE, TURN_END = "<|", "|>\n", "\n<|end|>\n"
NO_TURNS = "array<struct<role:string,text:string>>"


def in_rows(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``(key, turns)``: the turns ``(role, text)`` of each conversation in order of turn, then
    of role and text where turns tie (null first).  Null role is ``user``, null text empty.  Null
    keys form one conversation."""
    each = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("user")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = conversations.groupBy(key).agg(F.sort_array(F.collect_list(each)).alias("t"))
    return rows.select(key, F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
                       .alias("turns"))


def pair(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, chosen, rejected)`` from two tables of ``in_rows``.  A key that one side
    lacks pairs with an empty conversation; null keys pair with each other."""
    a = chosen.select(F.col(key).alias("ka"), F.col("turns").alias("chosen"))
    b = rejected.select(F.col(key).alias("kb"), F.col("turns").alias("rejected"))
    none = F.array().cast(NO_TURNS)
    return a.join(b, F.col("ka").eqNullSafe(F.col("kb")), "full").select(
        F.coalesce("ka", "kb").alias(key), F.coalesce("chosen", none).alias("chosen"),
        F.coalesce("rejected", none).alias("rejected"))


def stale_answers(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs from plain conversations (``in_rows``): chosen ends with the last assistant turn;
    rejected answers there with the assistant turn before it, or with nothing if
    there is none.  Conversations without an assistant turn have no pair."""
    places = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i)), lambda i: i.isNotNull())
    marked = rows.withColumn("places", places).where(F.size("places") > 0).withColumn("last", F.element_at("places", -1))
    stale = F.filter(F.slice("turns", 1, F.col("last")), lambda t: t["role"] == "assistant")
    return marked.select(
        key, F.slice("turns", 1, F.col("last") + 1).alias("chosen"),
        F.concat(F.slice("turns", 1, F.col("last")),
                 F.slice(stale, F.greatest(F.size("places") - 1, F.lit(1)), 1)).alias("rejected"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(ROLE_OPEN), role, F.lit(ROLE_CLOSE), text, F.lit(TURN_END))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")


def _mask(turns: Column) -> Column:
    """Spans ``(start, end)`` of the assistant's texts and end marks, in code points of the completion."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        head = F.length(t["role"]) + len(ROLE_OPEN) + len(ROLE_CLOSE)
        end = s["at"] + head + F.length(t["text"]) + len(TURN_END)
        span = F.struct((s["at"] + head).cast("int").alias("start"), end.cast("int").alias("end"))
        return F.struct(end.cast("int").alias("at"), F.when(t["role"] == "assistant", F.concat(s["spans"], F.array(span)))
                        .otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_pairs(pairs: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask`` for each row of
    ``pairs`` (``key``, ``chosen``, ``rejected``).

    The prefix ends before the first place where role or text differ or one side ends.  Two equal
    conversations have empty completions.
    """
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    differs = F.array_position(same, F.lit(False))
    cut = pairs.withColumn("n_prefix", F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int"))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_prefix") + 1, F.size(side))

    return (cut.select(key, "n_prefix", F.slice("chosen", 1, F.col("n_prefix")).alias("p"), rest("chosen").alias("c"),
                       rest("rejected").alias("r"))
            .select(key, F.col("n_prefix").cast("bigint").alias("n_prefix"), _joined(F.col("p")).alias("prompt"),
                    _joined(F.col("c")).alias("chosen"), _joined(F.col("r")).alias("rejected"),
                    _mask(F.col("c")).alias("chosen_mask"), _mask(F.col("r")).alias("rejected_mask")))
