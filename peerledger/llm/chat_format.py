"""Chat formatting by multi-party perspective rotation.

Every participant of a dialogue is the assistant once: its turns become assistant turns and are what the loss mask covers, all other
speakers are named users. A rendered dialogue comes in parts of at most `turns` turns, so a dialogue of any length stays in
bounded rows; `start` places a part's text in the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerledger.operators.ranking import BUCKET, GROUP, with_offsets
from peerledger.session import stage

TURNS = 64
BUCKET_TURNS = 256
CROWDED = 4096
HEX = 16


def _placed(turns: DataFrame) -> DataFrame:
    """Add `pos`, each turn's place in its dialogue, by turn, role and digest of the text (NULL first).

    A bucket is a stretch of turn numbers. Where a stretch is crowded, as when one turn number is given to very many rows, buckets
    are one number, one role and a prefix of the digest, as long as the count asks for.
    """
    stretch = F.floor(F.col("turn") / BUCKET_TURNS)
    coarse = turns.withColumn(GROUP, F.struct("conv")).withColumn("stretch", F.struct(stretch.alias("stretch")))
    crowds = stage(coarse.groupBy(GROUP, "stretch").agg(F.count("*").alias("crowd")), "crowded-stretches")
    known = coarse.join(crowds, [GROUP, "stretch"])
    # Each digit of the digest splits a crowd by 16.
    digits = F.when(F.col("crowd") <= CROWDED, F.lit(0)).otherwise(F.ceil(F.log(F.col("crowd") / CROWDED) / F.log(F.lit(float(HEX)))).cast("int"))
    crowded = F.col("crowd") > CROWDED
    fine = F.struct(
        F.col("stretch.stretch").alias("stretch"),
        F.when(crowded, F.col("turn")).alias("turn"),
        F.when(crowded, F.col("role")).alias("role"),
        F.when(crowded, F.substring("digest", F.lit(1), digits)).alias("digest"),
    )
    placed = with_offsets(known.withColumn(BUCKET, fine).drop("stretch", "crowd"), {"_before": F.count("*")})
    inside = Window.partitionBy(GROUP, BUCKET).orderBy("turn", "role", "digest")
    return placed.withColumn("pos", F.row_number().over(inside) - 1 + F.col("_before")).drop(GROUP, BUCKET, "_before")


def head_of(role: Column, perspective: Column, context: Sequence[str]) -> Column:
    named = F.concat(F.lit("<|user name="), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"))
    plain = F.concat(F.lit("<|"), role, F.lit("|>\n"))
    return F.when(role == perspective, F.lit("<|assistant|>\n")).when(role.isin(*context), plain).otherwise(named)


END = "<|end|>\n"


def rotate(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    context: Sequence[str] = ("system",),
    turns: int = TURNS,
) -> DataFrame:
    """One row per dialogue, participant and part: (conv, perspective, part, start, text, n_turns, masks).

    `masks` are the spans (begin, end) of the part's text that the assistant speaks, its end mark included. Participants are the
    roles of a dialogue other than NULL and `context`; a dialogue without any gives no row. Rows equal in conv, turn, role and text
    are one turn. A NULL conv is a dialogue, a NULL role an unknown user, a NULL text empty, a NULL turn comes first; other turns
    that share a number go by role and digest. Other columns are not read.
    """
    read = conversations.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.col(f"`{role}`").alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    said = stage(read.distinct().withColumn("digest", F.md5(F.col("text").cast("binary"))), "turns")
    placed = _placed(said)
    speakers = said.filter(F.col("role").isNotNull() & ~F.col("role").isin(*context)).select(F.struct("conv").alias("at"), F.col("role").alias("perspective"))
    speakers = stage(speakers.distinct(), "speakers")
    seen = placed.withColumn("at", F.struct("conv")).join(speakers, "at")
    head = head_of(F.col("role"), F.col("perspective"), context)
    pieces = seen.select(
        "at",
        "perspective",
        F.floor(F.col("pos") / turns).cast("int").alias("part"),
        F.struct(
            "pos",
            F.concat(head, "text", F.lit(END)).alias("piece"),
            F.length(head).alias("head"),
            F.coalesce(F.col("role") == F.col("perspective"), F.lit(False)).alias("own"),
        ).alias("turn"),
    )
    parts = pieces.groupBy("at", "perspective", "part").agg(F.array_sort(F.collect_list("turn")).alias("list"))
    whole = F.array_join(F.col("list.piece"), "")
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(done: Column, item: Column) -> Column:
        end = done["at"] + F.length(item["piece"])
        span = F.struct((done["at"] + item["head"]).alias("begin"), end.alias("end"))
        spans = F.when(item["own"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    rendered = parts.select("at", "perspective", "part", whole.alias("text"), F.size("list").alias("n_turns"), F.aggregate("list", empty, step).alias("done"))
    rendered = stage(rendered.select("at", "perspective", "part", "text", "n_turns", F.col("done.at").alias("length"), F.col("done.spans").alias("masks")), "parts")
    earlier = Window.partitionBy("at", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rendered.select("at", "perspective", "part", "length")
    starts = sizes.select("at", "perspective", "part", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("start"))
    placed_parts = rendered.join(starts, ["at", "perspective", "part"])
    return placed_parts.select(F.col("at.conv").alias(conv), "perspective", "part", "start", "text", "n_turns", "masks")
