"""Chat formatting by perspective rotation (built-in functions only).

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and all others as named
users. The mask says which characters are trained on: what the speaker says and the mark that ends it. System turns
keep their role and are no participant.

Turns are grouped into parts of ``turns_per_part`` consecutive turn numbers, so that no dialogue is gathered in one
row however long it is; parts follow each other without overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.session import stage

END_OF_TURN = "<|end|>\n"


def _defused(text: Column) -> Column:
    """Marks within a text or name are broken up, so that only the template makes marks."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _head(role: Column, speaker: Column) -> Column:
    return (
        F.when(role == "system", "<|system|>\n")
        .when(role == speaker, "<|assistant|>\n")
        .otherwise(F.concat(F.lit("<|user name="), _defused(role), F.lit("|>\n")))
    )


def rotate(
    turns: DataFrame,
    turns_per_part: int = 256,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation, speaker and part: conv_id, speaker, part, n_turns, text, spans, n_trained.

    ``spans`` are (start, end) in code points of ``text``, end excluded. A null or empty role is the participant
    ``unknown``; a null text is empty; turns without a number come first, in part -1. Equal turn numbers stand in the order of role and
    text; repeated rows are repeated. A null conversation id is one conversation. A conversation of system turns only has
    no participant and gives no row. A part of a speaker who says nothing in it has no spans. Other columns are not read.
    """
    named = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.nullif(F.col(f"`{role_col}`"), F.lit("")), F.lit("unknown")).alias("role"),
        _defused(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("content"),
    )
    speakers = named.where("role <> 'system'").select(F.col("conv_id").alias("conv"), F.col("role").alias("speaker")).distinct()
    speakers = stage(speakers, "speakers")
    part = F.coalesce(F.floor(F.col("turn") / turns_per_part), F.lit(-1)).cast("long").alias("part")
    parts = named.groupBy("conv_id", part).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))).alias("turns"))
    rotated = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv")))

    speaker = F.col("speaker")
    heads = F.transform("turns", lambda t: F.struct(_head(t["role"], speaker).alias("head"), t["content"].alias("content"), (t["role"] == speaker).alias("own")))
    rotated = rotated.select("conv_id", "speaker", "part", heads.alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["content"], F.lit(END_OF_TURN))), "")
    nothing = F.array().cast("array<struct<start:long,end:long>>")

    def step(done: Column, t: Column) -> Column:
        start = done["at"] + F.char_length(t["head"])
        end = start + F.char_length(t["content"]) + len(END_OF_TURN)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["own"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("spans"))
    spans = F.aggregate("turns", begin, step, lambda done: done["spans"])
    rotated = rotated.select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), spans.alias("spans"))
    trained = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return rotated.withColumn("n_trained", trained)
