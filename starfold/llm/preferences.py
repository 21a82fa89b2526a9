"""Preference pairs: the common opening of two conversations once as prompt, then both endings with their masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starfold.llm.successors import successors

HEAD, END = "<|{}|>\n", "<|end|>\n"


def conversations(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(id, turns): an array of (turn, role, text) in the order of turn, role and text, nulls first.

    Null roles and texts become empty. Repeated rows stay. Turns without an id are one conversation with a null id.
    """
    turn = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return turns.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _rendered(turn: Column) -> Column:
    # A text cannot open or end a turn: the bar of a marker that it contains is doubled.
    head = F.concat(F.lit("<|"), F.replace(turn["role"], F.lit("<|"), F.lit("<||")), F.lit("|>\n"))
    return F.concat(head, F.replace(turn["text"], F.lit("<|"), F.lit("<||")), F.lit("\n" + END))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column, trained_role: str) -> Column:
    """Spans (start, end) of a rendered ending that are trained on: the trained role's texts with their end marks."""
    span = "array<struct<start:bigint,end:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        size = F.length(_rendered(turn)).cast("long")
        head = F.length(F.replace(turn["role"], F.lit("<|"), F.lit("<||"))) + F.lit(5)
        here = F.array(F.struct((acc["at"] + head).cast("long").alias("start"), (acc["at"] + size).alias("end")))
        spans = F.when(turn["role"] == trained_role, F.concat(acc["spans"], here.cast(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + size).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_preferences(pairs: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask) for rows (pair_id, chosen, rejected).

    `chosen` and `rejected` are arrays of turns as in `conversations`. `n_common` is the length of the longest common
    prefix of turns (same role and text); these are rendered once as the prompt, the rest of each as its completion.
    Masks are spans in code points of a completion, end exclusive, that a loss is taken on; none lies in the prompt. If
    one conversation continues the other, the other's completion is empty; equal ones both are. Null arrays are empty.
    """
    turns = lambda c: F.coalesce(F.col(c), F.array().cast(pairs.schema[c].dataType))
    rows = pairs.select("pair_id", turns("chosen").alias("c"), turns("rejected").alias("r"))
    same = F.zip_with("c", "r", lambda a, b: F.coalesce(
        (a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    differs = F.array_position(same, False)
    rows = rows.withColumn("n", F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c))
    return rows.select(
        "pair_id", F.col("n").cast("long").alias("n_common"),
        _joined(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _joined(rest("c")).alias("chosen"), _joined(rest("r")).alias("rejected"),
        _mask(rest("c"), trained_role).alias("chosen_mask"), _mask(rest("r"), trained_role).alias("rejected_mask"),
    )


def swapped_answers(convs: DataFrame, role: str = "assistant") -> DataFrame:
    """Pairs made from conversations: each as it is, and with its last answer replaced by the next one's last answer.

    The next conversation is the one with the next larger id, after the last the first. A conversation without an
    answer is left as it is; one whose successor has none gets an empty answer. Null ids pair with an empty answer.
    """
    rows = convs.withColumn("answers", F.filter("turns", lambda t: t["role"] == role))
    rows = rows.withColumn("answer", F.try_element_at(F.transform("answers", lambda t: t["text"]), F.lit(-1)))
    rows = rows.withColumn("last", F.size("turns") - F.array_position(
        F.reverse(F.transform("turns", lambda t: t["role"])), role).cast("int"))
    follow = successors(convs, "id")
    answers = rows.select(F.col("id").alias("next"), F.col("answer").alias("other"))
    joined = rows.join(follow.withColumnRenamed("key", "id"), "id", "left").join(answers, "next", "left")
    swapped = F.transform("turns", lambda t, i: F.when(
        (i == F.col("last")) & (F.size("answers") > 0),
        F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.coalesce("other", F.lit("")).alias("text")),
    ).otherwise(t))
    return joined.select(F.col("id").alias("pair_id"), F.col("turns").alias("chosen"), swapped.alias("rejected"))
