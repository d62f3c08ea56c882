"""Sharding by jump consistent hashing, with gapless places inside every shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerledger.session import stage_counted

# The multiplier of the published generator, and the two word sizes it uses.
MULTIPLIER = 2862933555777941757
WORD = 2**64
HALF = 2**31

ROWS_PER_BUCKET = 1000
CHUNK = 2**16


def unsigned(key: Column) -> Column:
    """A 64-bit integer read as unsigned; decimals, since bigint arithmetic may not wrap around."""
    wide = key.cast("decimal(20,0)")
    return F.when(key < 0, wide + F.lit(str(WORD)).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """(shard of `shards`, shard of `shards` + 1) of a 64-bit key.

    The generator seeded with the key says at which shard counts the key moves; its last move below the count is its shard.
    One more shard therefore takes keys only into itself. About ln(shards) moves matter, the rest of the fold is skipped.
    """
    start = F.struct(
        unsigned(key).alias("state"),
        F.lit(0).cast("bigint").alias("at"),
        F.lit(0).cast("bigint").alias("grown"),
        F.lit(0).cast("bigint").alias("next"),
    )

    def move(s: Column, _: Column) -> Column:
        drawn = ((s["state"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + 1) % F.lit(str(WORD)).cast("decimal(20,0)")).cast("decimal(20,0)")
        upper = F.floor(drawn / F.lit(2**33).cast("decimal(20,0)")).cast("double")
        moved = F.struct(
            drawn.alias("state"),
            F.when(s["next"] < shards, s["next"]).otherwise(s["at"]).alias("at"),
            s["next"].alias("grown"),
            F.floor((s["next"] + 1) * (F.lit(float(HALF)) / (upper + 1))).cast("bigint").alias("next"),
        )
        return F.when(s["next"] <= shards, moved).otherwise(s)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, move)
    return F.struct(walked["at"].cast("int").alias("shard"), walked["grown"].cast("int").alias("grown"))


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """One row per document: (key, size, text_crc32, law, shard, slot, grown_shard), the law being `key`.

    Key and shard count alone decide the shard, so a NULL key has a shard too. Size is the UTF-8 length plus 1; a NULL text has
    length 0 and the checksum of the empty text. Rows equal in key, size and checksum are interchangeable and are counted
    before anything is ordered, so a row repeated without end meets no task as rows. Other columns of `docs` are not read.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    jumps = jump_hash(F.xxhash64(F.col("key")), shards)
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), (F.octet_length(content) + 1).cast("bigint").alias("size"), F.crc32(content.cast("binary")).alias("crc")
    )
    counted = rows.groupBy("key", "size", "crc").count().select("*", jumps.alias("jumps"))
    placed = counted.select("key", "size", "crc", "count", "jumps.shard", "jumps.grown")
    placed, distinct = stage_counted(placed, "sharded-keys")
    # Buckets split a shard evenly; totals per bucket give each bucket its first slot.
    buckets = max(1, distinct // (ROWS_PER_BUCKET * shards))
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("crc", "key", "size"), F.lit(buckets)))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("shard", "bucket").agg(F.sum("count").alias("total"))
    offsets = totals.select("shard", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "crc", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("count").over(inside), F.lit(0))
    spans = dealt.join(offsets, ["shard", "bucket"]).select("*", first.alias("first"))
    end = F.col("first") + F.col("count") - 1
    chunks = spans.withColumn("end", end).withColumn("from", F.explode(F.sequence("first", "end", F.lit(CHUNK).cast("bigint"))))
    slots = F.explode(F.sequence("from", F.least(F.col("from") + (CHUNK - 1), F.col("end"))))
    return chunks.select("key", "size", "crc", "shard", "grown", slots.alias("slot")).select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        F.col("grown").alias("grown_shard"),
    )
