"""Randomness that depends on the row, not on how Spark happened to partition it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = float(2**32)


def key_text(columns: Sequence[str]) -> Column:
    """One string per key; NULL parts keep their place, so (NULL, 'a') and ('a', NULL) differ."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
    return F.concat_ws("|", *parts)


def seeded_digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))


def leading_bits(digest: Column) -> Column:
    """First 32 bits of a hex digest as a bigint."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def unit_hash(key: Column, seed: int) -> Column:
    """Uniform in [0, 1), a pure function of key and seed."""
    return leading_bits(seeded_digest(key, seed)) / F.lit(UNIT)
