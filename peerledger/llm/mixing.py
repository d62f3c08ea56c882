"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix has equal-token blocks, so small that every source comes near its target. Every block goes to the source with the highest quotient target / (2k + 1),
k being the blocks it already has; the order of the awards deals them to the mix's shards, so each shard has an integer quota
per source and close to the target proportions. A source lays its documents end to end in seeded order, as a ring; its quotas are
consecutive blocks of that ring from its start on, so which words a document gives, and to which shard, follows from its place
alone. Nothing is sampled: reruns agree, and a source gives its whole quota.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerledger.operators.ranking import BUCKET, GROUP, with_offsets
from peerledger.session import stage

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 1000
NEAR = 1 / 64  # of its target, by which a source's quota may miss it
PLACE_BITS = 33  # monotonically_increasing_id() keeps the place inside a partition in this many bits


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add `place`, the 0-based rank of each row in a total order, by a range sort and one count per sorted partition."""
    ordered = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part, inside = F.shiftright("_at", PLACE_BITS), F.col("_at").bitwiseAND(2**PLACE_BITS - 1)
    counts = ordered.groupBy(part.alias("_part")).count()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    return ordered.withColumn("_part", part).join(offsets, "_part").withColumn("place", inside + F.col("_before")).drop("_at", "_part", "_before")


def targets(sources: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """Add `weight` (by rank of the source, in turn) and `target` to (source, source_size).

    The targets are in proportion to the weights and sum to `share` of all sizes, but none is above `limit` times its source's
    size: what is above goes to the others by weight, until none is above.
    """
    placed = numbered(sources, [F.col("source").asc_nulls_last()], "sources-in-order")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = placed.withColumn("weight", turn[F.pmod("place", F.lit(len(weights))).cast("int")])
    bound = F.col("source_size") * limit
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, free = 0.0, None
    while True:  # each round fixes at least one more source at its limit; only scalars come to the driver
        full = bound <= F.col("weight") * level
        row = weighed.agg(
            F.sum(F.when(full, bound)).alias("fixed"), F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count(F.when(~full, 1)).alias("free")
        ).first()
        if not row["free"] or row["free"] == free:
            break
        free, level = row["free"], max(level, (share * total - (row["fixed"] or 0.0)) / row["weight"])
    return weighed.withColumn("target", F.least(bound.cast("double"), F.col("weight") * level)).drop("place")


def quotas(sources: DataFrame, blocks: int, shards: int) -> DataFrame:
    """(source, cuts): blocks of the source before each shard of the mix, and after the last.

    Blocks are counted, not listed: the awards down to a quotient are known from a source's target, and only those near the end of
    a shard, about two for each source, are ranked.
    """
    total, count = sources.agg(F.sum("target"), F.count("*")).first()
    per_shard = -(-blocks // shards) or 1
    ends = {s: min(s * per_shard, blocks) for s in range(1, shards + 1)}
    spare = count / 2 + 1

    def seats(awards: float) -> Column:
        """Awards of a source down to the quotient total / (2 * awards); of all sources, `awards` give or take half their number."""
        return F.floor(F.col("target") * F.lit(max(0.0, awards) / (total or 1.0)) + F.lit(0.5))

    per_end = [F.struct(F.lit(s).alias("shard"), seats(n - spare).alias("sure"), seats(n + spare).alias("most")) for s, n in ends.items()]
    near = sources.select("source", "target", F.explode(F.array(*per_end)).alias("_")).select("source", "target", "_.*")
    rows = near.groupBy("shard").agg(F.sum("sure").alias("sure"), F.sum(F.col("most") - F.col("sure")).alias("open")).collect()
    known, before, ranks = {r["shard"]: r for r in rows}, 0, []
    for s, n in ends.items():
        if s in known:
            ranks += [F.lit(s), F.lit(before + n - known[s]["sure"])]
            before += known[s]["open"]
    unsure = near.filter(F.col("most") > F.col("sure")).select("*", F.explode(F.sequence("sure", F.col("most") - 1)).alias("k"))
    unsure = unsure.select("source", "shard", "k", (F.col("target") / (2 * F.col("k") + 1)).alias("quotient"))
    ranked = numbered(unsure, [F.asc("shard"), F.desc("quotient"), F.col("source").asc_nulls_last(), F.asc("k")], "awards")
    won = ranked.filter(F.col("place") < F.element_at(F.create_map(*ranks), F.col("shard"))) if ranks else ranked
    counted = near.select("source", "shard", F.col("sure").alias("n")).unionByName(won.select("source", "shard", F.lit(1).cast("bigint").alias("n")))
    sums = [F.coalesce(F.sum(F.when(F.col("shard") == s, F.col("n"))), F.lit(0)).alias(f"_{s}") for s in range(shards + 1)]
    return counted.groupBy("source").agg(*sums).select("source", F.array(*[F.col(f"_{s}") for s in range(shards + 1)]).alias("cuts"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    shards: int = 8,
    blocks: int = 2**16,
    seed: int = 17,
    carry: list[Column] | None = None,
) -> DataFrame:
    """One row per document: (doc, size, source_size, target, taken, per_shard).

    `taken` counts the words that the mix takes, repeats counted, at most twice the size; `per_shard` says how many of them go to
    each shard. The mix has about `blocks` blocks in all (more where there are so many sources that each could not have 64). Where
    a source would then miss its target by more than a 64th, the blocks are made a 128th of the smallest target, or one word. Sources without words, and NULL texts, have target or size 0; a NULL source is a
    source of its own. An empty table gives an empty result. `doc` holds the columns of `docs`, or `carry`.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sized = docs.select(
        F.struct(*(carry or [F.col(f"`{c}`") for c in docs.columns])).alias("doc"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.regexp_count(content, F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.crc32(content.cast("binary"))).alias("draw"),
    )
    sized = stage(sized, "sized-documents")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    weighed = stage(targets(per_source, weights, share, limit), "source-targets")
    total, count, least = weighed.agg(F.sum("target"), F.count("*"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    block = max(1, round((total or 0.0) / max(blocks, 64 * count)))
    none = F.array_repeat(F.lit(0).cast("bigint"), shards + 1)
    same = F.col("w.source").eqNullSafe(F.col("d.source"))

    def cut(block: int) -> DataFrame:
        dealt = quotas(weighed, round((total or 0.0) / block), shards)
        known = weighed.alias("w").join(dealt.alias("d"), same, "left").select("w.*", F.coalesce("d.cuts", none).alias("blocks"))
        words = F.transform("blocks", lambda b: F.least(b * block, F.floor(F.col("source_size") * limit)))
        return stage(known.select(F.struct("source").alias(GROUP), "source_size", "target", "rows", words.alias("cuts")), "source-quotas")

    sources = cut(block)
    missed = F.abs(F.col("cuts")[shards] - F.col("target")) > F.col("target") * NEAR
    if block > 1 and not sources.filter(missed).isEmpty():
        # This small, a source's quota is off by at most half a block and 1/128 of its target, the spread of the lowest quotient.
        sources = cut(max(1, min(block, int(least * NEAR / 2))))

    placed = sized.withColumn(GROUP, F.struct("source")).join(sources, GROUP)
    buckets = F.floor(F.col("rows") / ROWS_PER_BUCKET) + 1
    placed = placed.withColumn(BUCKET, F.pmod(F.col("draw"), buckets))
    placed = with_offsets(placed.drop("source"), {"_before": F.sum("size")})
    inside = Window.partitionBy(GROUP, BUCKET).orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("from", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))

    def given(low: Column, high: Column) -> Column:
        def lap(n: int) -> Column:
            begin = F.col("from") + n * F.col("source_size")
            return F.greatest(F.lit(0), F.least(begin + F.col("size"), high) - F.greatest(begin, low))

        return sum((lap(n) for n in range(1, int(-(-limit // 1)))), lap(0))

    given_to = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: given(F.col("cuts")[s], F.col("cuts")[s + 1]))
    placed = placed.select("doc", "size", "source_size", "target", given_to.alias("per_shard"))
    taken = F.aggregate("per_shard", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return placed.select("doc", "size", "source_size", "target", taken.alias("taken"), "per_shard")
