"""Join helpers with checked broadcast sizes."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.session import stage_measured

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 2**20
#: Bytes of a value of fixed width in a row.
WORD = 8


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row in a broadcast relation: a word for each column, and the contents of those of no fixed width."""

    def contents(field: T.StructField) -> Column | None:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.length(F.to_json(F.struct(name)))
        return None

    sizes = [F.coalesce(c, F.lit(0)) for c in map(contents, schema.fields) if c is not None]
    return reduce(Column.__add__, sizes, F.lit(WORD * (len(schema.fields) + 1))).cast("bigint")


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Stage `df`, and hint a broadcast only if it turned out to have at most `max_rows` rows and `max_bytes` bytes.

    A larger side keeps the shuffle join, where adaptive execution splits skewed partitions.
    Staging means the size check does not compute the side a second time.
    """
    staged, seen = stage_measured(df, "join-side", bytes=F.sum(row_bytes(df.schema)))
    fits = seen["rows"] <= max_rows and (seen["bytes"] or 0) <= max_bytes
    return F.broadcast(staged) if fits else staged.hint("merge")  # compressed files may look small to the optimizer


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    usable = df.dropna(subset=list(keys))
    if not repeated_keys(usable, keys).isEmpty():
        raise ValueError(f"{list(keys)} is not unique, the join would multiply rows")
    return df


def join_summary(
    stats: DataFrame,
    summary: DataFrame,
    keys: Sequence[str] = ("rndrng_npi", "year"),
    check_unique: bool = True,
) -> DataFrame:
    """Inner join on the keys. Columns that both sides have are taken from `stats`.

    Keys that can match must be unique; 0 stands for ids that did not parse and matches no claim.
    """
    shared = [c for c in summary.columns if c in stats.columns and c not in keys]
    right = summary.drop(*shared)
    if check_unique:
        require_unique(right.filter(F.col(keys[0]) != 0), keys)
    return stats.join(right, list(keys), "inner")
