"""Perspective rotation of dialogues: every participant in turn is the assistant.

For each participant of a conversation the whole dialogue is rendered with that speaker as
assistant, everybody else as named user and system turns as they are. A rendering comes as its
segments in order, each with its place in the text, so a conversation of any length stays spread
over tasks; laid end to end the segments are the text, and the loss mask is the trained ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.shared import staged

# Fixed values of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
USER = "user name="
NOBODY = "unknown"
BLOCK = 256
"""Turn numbers of one block; places are counted inside blocks, then over blocks."""
FRONT = 3
"""First characters that part turns without a number."""


def rotate(conversations: DataFrame) -> DataFrame:
    """One row per turn and perspective.

    conv_id, speaker (whose perspective), place (0, 1, ... in the rendering), turn, role, spoken_as
    (assistant, user, system), segment (rendered text), start and finish (characters in the
    rendering), trained_from (where the loss begins; null where nothing is trained).

    Order: turn (null last), role, text. A null role is the participant ``unknown``, a null text is
    empty, turns that repeat are all kept, a conversation of system turns alone has no perspective
    and gives none, an empty table gives none, further columns are ignored. Template marks inside a
    text are broken by a space, so no text can open or close a turn.

    Turns are numbered and measured once, as the others see them; a perspective only moves a turn by a
    fixed number of characters per earlier turn of its speaker. Texts are multiplied last.
    """
    numbered = _numbered(conversations)
    narrow = numbered.drop("turn", "text")
    earlier = Window.partitionBy("conv_id", "speaker").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    speakers = staged(
        narrow.where(F.col("role") != SYSTEM).groupBy("conv_id", F.col("role").alias("speaker")).agg(F.lit(0)),
        "speakers",
    ).select(F.col("conv_id").alias("of"), "speaker")
    # Per block and perspective: what stands before the block, and how much of it the speaker said.
    counts = narrow.groupBy("conv_id", "block", "role").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    blocks = counts.groupBy("conv_id", "block").agg(
        F.sum("n").alias("n"), F.sum("size").alias("size"),
        F.map_from_entries(F.collect_list(F.struct("role", "n"))).alias("said"),
    )
    before = blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), "speaker",
        *(
            F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{name}_before")
            for name, x in (
                ("rows", F.col("n")), ("size", F.col("size")),
                ("own", F.coalesce(F.try_element_at("said", F.col("speaker")), F.lit(0))),
            )
        ),
    )
    inside = Window.partitionBy("conv_id", "speaker", "block").orderBy("nth").rowsBetween(
        Window.unboundedPreceding, -1
    )
    own = F.col("role") == F.col("speaker")
    moved = F.lit(len("assistant") - len(USER)) - F.length(_plain(F.col("speaker")))
    views = narrow.join(before, _same("conv_id", "c") & (F.col("block") == F.col("b"))).select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.col("nth").alias("k"), "speaker",
        (F.col("rows_before") + F.col("nth")).alias("place"),
        (
            F.col("size_before") + F.col("upto") - F.col("size")
            + moved * (F.col("own_before") + F.coalesce(F.sum(own.cast("long")).over(inside), F.lit(0)))
        ).alias("start"),
    )
    spoken_as = F.when(F.col("role") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    head = F.when(own, f"{OPEN}assistant\n").otherwise(_head(F.col("role")))
    start = F.col("start")
    return (
        numbered.join(views, _same("conv_id", "c") & (F.col("block") == F.col("b")) & (F.col("nth") == F.col("k")))
        .withColumn("head", head).withColumn("segment", F.concat("head", _tail(F.col("text"))))
        .select(
            "conv_id", "speaker", "place", "turn", "role", spoken_as.alias("spoken_as"), "segment", "start",
            (start + F.length("segment")).alias("finish"),
            F.when(own, start + F.length("head")).alias("trained_from"),
        )
    )


def _numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, block; nth in the block, size, and size up to here (as others see it).

    Blocks follow the order of the turns. Those without a number are parted by role and first characters.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(NOBODY)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    unnumbered = F.col("turn").isNull()
    block = F.struct(
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(2**62)).cast("long").alias("number"),
        F.when(unnumbered, F.col("role")).otherwise("").alias("role"),
        F.when(unnumbered, F.substring("text", 1, FRONT)).otherwise("").alias("front"),
    )
    size = F.length(_head(F.col("role"))) + F.length(_tail(F.col("text")))
    order = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return staged(
        rows.withColumn("block", block).withColumn("size", size.cast("long"))
        .withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))), "turns",
    )


def _same(one: str, other: str) -> Column:
    return F.col(one).eqNullSafe(F.col(other))


def _head(role: Column) -> Column:
    """How a turn opens for everybody but its speaker."""
    named = F.concat(F.lit(OPEN + USER), _plain(role), F.lit("\n"))
    return F.when(role == SYSTEM, f"{OPEN}{SYSTEM}\n").otherwise(named)


def _tail(text: Column) -> Column:
    return F.concat(_plain(text), F.lit(CLOSE + "\n"))


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|im_"), F.lit("< |im_"))
