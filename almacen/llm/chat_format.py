"""Chat formatting: one dialogue, told from the side of each of its speakers.

For every participant the whole dialogue is rendered with that speaker's turns as
the assistant's and all others' as those of named users; training counts only
the assistant's words. Turns of the system are instructions to every side.

A dialogue is not gathered into one value: each turn is a row that says where its
segment stands in the rendered dialogue and which characters count, so a dialogue
may have any number of turns. Positions are sums over blocks of turns first and
within a block then, so that one long dialogue is many tasks' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
UNNAMED = "unknown"
#: Turns of a block.
BLOCK = 64


def render(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each turn and participant of its dialogue.

    Columns: conv_id, perspective (the participant), turn, position (from 1), label,
    segment (rendered text), starts_at and ends_at (characters of the rendered
    dialogue), learns_from (first character that counts; null where none does), mask.
    Segments in the order of position, end to end, are the dialogue.

    Turns come by number, then speaker, then text; without a number they come last.
    A null role speaks as ``unknown``, a null text is empty; markers inside a text
    are broken up by a space. Turns without a conversation are one dialogue.
    Dialogues of the system alone have no participants and no rows. Repeated rows are
    repeated turns; other columns are not looked at; no rows give no rows.
    """
    said = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(UNNAMED)).alias("speaker"),
        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    )
    sides = said.filter(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")
    )
    rows = said.join(sides.distinct(), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    name = F.regexp_replace("speaker", r"[\x00-\x20<>|]", "_")
    own = F.col("speaker") == F.col("perspective")
    label = F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM)).when(own, F.lit("assistant"))
    label = label.otherwise(F.concat(F.lit("user name="), name))
    rows = rows.withColumn("label", label).withColumn("mask", own)
    rows = rows.withColumn("head", F.concat(F.lit(START), "label", F.lit("\n")))
    rows = rows.withColumn("segment", F.concat("head", "text", F.lit(END)))
    rows = rows.withColumn("length", F.length("segment").cast("long"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))

    by = ["conv_id", "perspective"]
    blocks = rows.groupBy(*by, "block").agg(
        F.count("*").alias("turns"), F.sum("length").alias("characters")
    )
    earlier = Window.partitionBy(*by).orderBy(F.col("block").asc_nulls_last())
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    blocks = blocks.select(
        *[F.col(c).alias(f"of_{c}") for c in (*by, "block")],
        F.coalesce(F.sum("turns").over(earlier), none).alias("turns_before"),
        F.coalesce(F.sum("characters").over(earlier), none).alias("characters_before"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*by, "block")]
    rows = rows.join(blocks, same[0] & same[1] & same[2])
    within = Window.partitionBy(*by, "block").orderBy("turn", "speaker", "text")
    until = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("position", F.col("turns_before") + F.row_number().over(within))
    rows = rows.withColumn("ends_at", F.col("characters_before") + F.sum("length").over(until))
    starts = F.col("ends_at") - F.col("length")
    learns = F.when(F.col("mask"), starts + F.length("head"))
    return rows.select(
        *by,
        "turn",
        "position",
        "label",
        "segment",
        starts.alias("starts_at"),
        "ends_at",
        learns.alias("learns_from"),
        "mask",
    )
