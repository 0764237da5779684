"""Preference pairs from chosen and rejected conversations.

The longest common run of leading turns is rendered once as the prompt. What follows on each
side is rendered as a completion with a mask: the spans, in characters, of assistant turns
with their end mark, which a loss may count; headers and other turns stay outside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import only
from tidepanel.session import materialise

END = "<|end|>\n"


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Spans (start, end) of the assistant's words in the rendered turns."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(_head(t))
        end = start + F.length(t["text"]) + len(END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["out"], span))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, first, step, lambda a: a["out"])


def _turns(side: DataFrame, name: str) -> DataFrame:
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return only(side, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        "conv_id", F.lit(name).alias("side"), F.struct("turn", filled("role"), filled("text")).alias("t"))


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per conversation that both sides have: ``prompt``, ``chosen`` and ``rejected``
    with their masks, ``n_common`` turns of the prompt, and ``differs``: both completions have
    an assistant turn and they are not equal.

    Sides hold (conv_id, turn, role, text). Turns are compared by role and text in the order of
    ``turn``; a null turn comes first, turns with equal number follow by role and text, null role
    or text counts as empty. A null conv_id is no conversation. One side being a prefix of
    the other, or equal to it, leaves an empty completion. Other columns are ignored.
    """
    both = _turns(chosen, "c").unionAll(_turns(rejected, "r"))
    gather = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("t"))))
    rows = both.groupBy("conv_id").agg(gather("c").alias("c"), gather("r").alias("r")) \
        .where((F.size("c") > 0) & (F.size("r") > 0))
    alike = F.zip_with("c", "r", lambda x, y: F.coalesce(
        (x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(alike, F.lit(False))
    rows = rows.withColumn("n_common", F.when(first > 0, first - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda s: F.slice(F.col(s), F.col("n_common") + 1, F.greatest(F.lit(1), F.size(s)))
    rows = rows.select("conv_id", "n_common", F.slice("c", F.lit(1), F.col("n_common")).alias("p"),
                       rest("c").alias("c"), rest("r").alias("r"))
    out = rows.select("conv_id", "n_common", _rendered(F.col("p")).alias("prompt"),
                      _rendered(F.col("c")).alias("chosen"), _mask(F.col("c")).alias("chosen_mask"),
                      _rendered(F.col("r")).alias("rejected"), _mask(F.col("r")).alias("rejected_mask"))
    return out.withColumn("differs", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0)
                          & (F.col("chosen") != F.col("rejected")))


def _next(ids: DataFrame) -> DataFrame:
    """(conv_id, partner): the next id in order, the first one for the last. Ids are ordered in
    ranges, one row for each of which goes on to find the next range's first id."""
    ranges = materialise(ids.repartitionByRange("conv_id").withColumn("range", F.spark_partition_id()), "ranges")
    within = ranges.withColumn("partner", F.lead("conv_id").over(Window.partitionBy("range").orderBy("conv_id")))
    firsts = ranges.groupBy("range").agg(F.min("conv_id").alias("first"))
    every = Window.partitionBy(F.lit(0)).orderBy("range")
    after = firsts.select("range", F.coalesce(
        F.lead("first").over(every), F.first("first").over(every)).alias("after"))
    return within.join(after, "range").select("conv_id", F.coalesce("partner", "after").alias("partner"))


def with_replies_of_others(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides of plain conversations: up to the last assistant turn as it
    is, and with that turn's text taken from the next conversation, in the order of ids of any
    type, that has an assistant turn; the last one takes the first one's.

    Conversations without an assistant turn are on neither side, all others on both; if there is
    only one, it meets its own reply. Null ids are no conversation, an assistant turn with a null
    number is none. Of several assistant turns with the last number, which all are replaced, the
    greatest text is the reply; rows that repeat stay. Other columns are ignored; an empty table
    gives empty sides.
    """
    rows = only(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    last = (rows.where("role = 'assistant' and turn is not null").groupBy("conv_id")
            .agg(F.max(F.struct("turn", "text")).alias("x")).select("conv_id", "x.turn", "x.text"))
    last = materialise(last, "replies")
    reply = last.select(F.col("conv_id").alias("partner"), F.col("text").alias("reply"))
    ends = last.select("conv_id", F.col("turn").alias("last")).join(_next(last.select("conv_id")), "conv_id") \
        .join(reply, "partner").drop("partner")
    cut = rows.join(ends, "conv_id").where("turn is null or turn <= last")
    swapped = F.when((F.col("turn") == F.col("last")) & (F.col("role") == "assistant"), F.col("reply")) \
        .otherwise(F.col("text"))
    return cut, cut.withColumn("text", swapped)
