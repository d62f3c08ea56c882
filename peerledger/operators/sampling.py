"""Undersampling and head samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.functions.hashing import key_text, seeded_digest, unit_hash


@dataclass(frozen=True)
class ClassCounts:
    positives: int
    negatives: int

    def keep_fraction(self, ratio: float) -> float:
        """Share of negatives to keep for `ratio` negatives per positive."""
        if self.negatives == 0:
            return 0.0
        return min(self.positives * ratio, self.negatives) / self.negatives


def count_classes(df: DataFrame, label: str = S.LABEL) -> ClassCounts:
    row = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    ).first()
    return ClassCounts(row["positives"], row["negatives"])


def kept(key: Column, label: Column, fraction: float, seed: int) -> Column:
    """Predicate: every positive, and a reproducible `fraction` of the negatives."""
    chosen = F.lit(True) if fraction >= 1 else unit_hash(key, seed) < F.lit(fraction)
    return (label == 1) | ((label == 0) & chosen)


def undersample(
    df: DataFrame,
    keys: Sequence[str],
    ratio: float = 100,
    seed: int = 42,
    label: str = S.LABEL,
    exact: bool = False,
) -> DataFrame:
    """All positives plus about `ratio` negatives for each.

    `keys` must identify a row. The choice is a hash of the key, so it is the same for any
    partitioning and after any task retry, and is a plain filter. exact=True keeps precisely the
    target number, those with the smallest hashes.
    """
    counts = count_classes(df, label)
    key = key_text(keys)
    if not exact:
        return df.filter(kept(key, F.col(label), counts.keep_fraction(ratio), seed))
    target = int(min(counts.positives * ratio, counts.negatives))
    digest = seeded_digest(key, seed)
    prefix = digest_cut(df.filter(F.col(label) == 0).select(digest.alias("digest")), target)
    below = F.lit(False) if prefix is None else F.substring(digest, 1, len(prefix)) <= prefix
    return df.filter((F.col(label) == 1) | ((F.col(label) == 0) & below))


def digest_cut(digests: DataFrame, target: int, step: int = 3) -> str | None:
    """The prefix up to which `target` of the hex digests lie; None for no digest.

    Each pass counts the digests by their next `step` digits, at most 16**step rows, and goes on inside the one in which the target
    falls. No row is sorted or moved.
    """
    if target <= 0:
        return None
    prefix, left = "", target
    while True:
        part = F.substring("digest", len(prefix) + 1, step).alias("part")
        inside = digests.filter(F.col("digest").startswith(prefix)) if prefix else digests
        for row in inside.groupBy(part).count().orderBy("part").collect():
            if left <= row["count"]:
                prefix += row["part"]
                break
            left -= row["count"]
        else:
            return "g"  # fewer digests than wanted: all of them
        if left == row["count"] or len(prefix) >= 32:
            return prefix


def head_sample(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """The first n rows in key order: the same rows on every run."""
    return df.orderBy(*keys).limit(n)


def class_weight(df: DataFrame, weight: float, label: str = S.LABEL, output: str = "weight") -> DataFrame:
    return df.withColumn(output, F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
