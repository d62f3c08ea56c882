"""Exact duplicates by deterministic block naming.

A text is cut into fixed-size blocks of bytes. Blocks are sorted into integer names: a block's name is its bucket (47 bits of
a hash) followed by its rank among the different blocks of that bucket. Adjacent names are then named in pairs, again and again,
until one integer is left of every document. Ranks are found by comparing the blocks or pairs themselves, so two documents
share an identity exactly when their texts are equal, whatever the hash does.

Only distinct blocks of a task are shuffled. A bucket nearly always holds one block, so its rank is 0 and a name needs no join;
the buckets that do hold several (`tied`) go through a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerledger.session import stage, stage_counted

BLOCK_BYTES = 4096
RANKS = 2**16
PAD = -1


def bucket_of(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 17)


def blocks_of(text: Column, block_bytes: int) -> Column:
    """The bytes of a text in blocks; NULL and the empty text are one empty block."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    last = F.greatest(F.octet_length(data) - 1, F.lit(0))
    starts = F.sequence(F.lit(0), F.floor(last / block_bytes).cast("int"))
    return F.transform(starts, lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))


def pairs_of(names: Column) -> Column:
    """Neighbours in pairs; the last of an odd number pairs with PAD, which no name equals."""
    return F.transform(
        F.sequence(F.lit(0), F.size(names) - 1, F.lit(2)),
        lambda i: F.struct(names[i].alias("l"), F.coalesce(F.get(names, i + 1), F.lit(PAD).cast("bigint")).alias("r")),
    )


def tied(keys: DataFrame, bucket: Callable[[Column], Column]) -> DataFrame | None:
    """(bucket, key, rank) of the buckets that hold several keys, or None where there are none."""
    held = keys.groupBy(bucket(F.col("key")).alias("bucket")).agg(F.collect_set("key").alias("keys"))
    found = held.filter(F.size("keys") > 1).select("bucket", F.posexplode(F.array_sort("keys")).alias("rank", "key"))
    checked = F.when(F.col("rank") < RANKS, F.col("rank")).otherwise(F.raise_error(F.lit("too many keys in one bucket")))
    kept, rows = stage_counted(found.withColumn("rank", checked.cast("bigint")), "tied-names")
    return kept if rows else None


def named(rows: DataFrame, tied_keys: DataFrame | None, bucket: Callable[[Column], Column]) -> DataFrame:
    """(row, keys) -> (row, names)."""
    if tied_keys is None:
        return rows.select("row", F.transform("keys", lambda k: bucket(k) * RANKS).alias("names"))
    flat = rows.select("row", F.posexplode("keys").alias("pos", "key")).withColumn("bucket", bucket(F.col("key")))
    name = F.col("bucket") * RANKS + F.coalesce("rank", F.lit(0))
    ranked = flat.join(tied_keys, ["bucket", "key"], "left").select("row", F.struct("pos", name.alias("name")).alias("at"))
    ordered = ranked.groupBy("row").agg(F.array_sort(F.collect_list("at")).alias("at"))
    return ordered.select("row", F.col("at.name").alias("names"))


def identities(
    docs: DataFrame,
    text: str = "text",
    carry: list[Column] | None = None,
    block_bytes: int = BLOCK_BYTES,
    bucket: Callable[[Column], Column] = bucket_of,
) -> DataFrame:
    """(row, doc, identity): a row number, the document's columns (or `carry`) as a struct, and one integer that equal texts
    and only they share. NULL texts count as empty. Columns of any name may occur in `docs`."""
    doc = F.struct(*(carry or [F.col(f"`{c}`") for c in docs.columns]))
    blocks = blocks_of(F.col(f"`{text}`"), block_bytes)
    tied_blocks = tied(docs.select(F.explode(blocks).alias("key")), bucket)
    base = docs.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc"), blocks.alias("keys"))
    if tied_blocks is None:
        named_keys = F.transform("keys", lambda k: bucket(k) * RANKS)
        state = stage(base.select("row", "doc", named_keys.alias("names")), "named-blocks")
        names = state.select("row", "names")
    else:
        state = stage(base, "document-blocks")
        names = stage(named(state.select("row", "keys"), tied_blocks, bucket), "named-blocks")
    longest = names.agg(F.max(F.size("names"))).first()[0] or 1
    levels = (longest - 1).bit_length()
    if not levels:
        return _with_identity(state, names)

    start = F.struct(F.col("names"), F.array().cast("array<struct<l:bigint,r:bigint>>").alias("pairs"))

    def up(at: Column, _: Column) -> Column:
        pairs = pairs_of(at["names"])
        upper = F.transform(pairs, lambda p: bucket(p) * RANKS)
        return F.struct(upper.alias("names"), F.concat(at["pairs"], pairs).alias("pairs"))

    climbed = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), start, up)
    if tied(names.select(F.explode(climbed["pairs"]).alias("key")), bucket) is None:
        top = climbed["names"]
        if tied_blocks is None:
            return state.select("row", "doc", top[0].alias("identity"))
        return _with_identity(state, names.select("row", top.alias("names")))
    for _ in range(levels):
        pairs = names.select("row", pairs_of(F.col("names")).alias("keys"))
        names = stage(named(pairs, tied(pairs.select(F.explode("keys").alias("key")), bucket), bucket), "named-pairs")
    return _with_identity(state, names)


def _with_identity(state: DataFrame, names: DataFrame) -> DataFrame:
    if "names" in state.columns:
        return state.select("row", "doc", F.col("names")[0].alias("identity"))
    return state.select("row", "doc").join(names.select("row", F.col("names")[0].alias("identity")), "row")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[Column] | None = None, **options) -> DataFrame:
    """One row per document: (doc, keep_id, group_size, kept).

    Of equal texts the row with the largest key stays; a NULL key loses to any other, and of rows that share key and text one
    stays. Exactly one row of every group is kept. An empty table gives an empty result. `carry` must name the key.
    """
    rows = identities(docs, text, carry, **options)
    best = F.max(F.struct(F.col(f"doc.`{key}`").alias("key"), "row"))
    groups = stage(rows.groupBy("identity").agg(best.alias("best"), F.count("*").alias("group_size")), "text-groups")
    return rows.join(groups, "identity").select(
        "doc", F.col("best.key").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept")
    )
