"""Provider-level stratified folds: a table (provider, fold), never driver lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.functions.hashing import leading_bits, seeded_digest
from peerledger.operators.labels import provider_labels
from peerledger.operators.ranking import hash_rank
from peerledger.session import stage


def stratified_folds(
    providers: DataFrame,
    k: int,
    seed: int = 42,
    provider: str = S.PROVIDER,
    label: str = S.LABEL,
    method: str = "exact",
    check: bool = True,
) -> DataFrame:
    """(provider, label, fold) with fold in 0..k-1.

    method="exact": class sizes differ by at most one between folds. method="hash": no shuffle,
    sizes balanced on average. `providers` has one row per provider.
    """
    if k < 2:
        raise ValueError("need at least two folds")
    if check:
        small = providers.groupBy(label).count().filter(F.col("count") < k).collect()
        if small:
            raise ValueError(f"classes with fewer than {k} providers: {[r[label] for r in small]}")
    base = providers.select(provider, label)
    if method == "hash":
        bits = leading_bits(seeded_digest(F.col(provider), seed))
        return base.withColumn("fold", (bits % k).cast("int"))
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    ranked = hash_rank(base, provider, seed, by=[label], output="_rank")
    return ranked.select(provider, label, ((F.col("_rank") - 1) % k).cast("int").alias("fold"))


def assign_folds(
    df: DataFrame, k: int, seed: int = 42, provider: str = S.PROVIDER, label: str = S.LABEL, **options
) -> DataFrame:
    """Add the provider's fold to every row; rows without a provider belong to no fold.

    The provider labels are staged, so `df` is read once for them and once for the result. A
    provider with very many rows makes one partition of the join large, which adaptive execution
    splits; no result depends on how rows are spread.
    """
    providers = stage(provider_labels(df, label, provider), "provider-labels")
    folds = stratified_folds(providers, k, seed, provider, label, **options)
    return df.join(folds.select(provider, "fold"), provider, "inner")


def split(df: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) of one fold: two filters over the same frame."""
    return df.filter(F.col("fold") != fold), df.filter(F.col("fold") == fold)


def semi_split(
    df: DataFrame, folds: DataFrame, fold: int, provider: str = S.PROVIDER
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a frame that carries no fold column, by provider membership."""
    test_side = folds.filter(F.col("fold") == fold).select(provider)
    train_side = folds.filter(F.col("fold") != fold).select(provider)
    return df.join(train_side, provider, "left_semi"), df.join(test_side, provider, "left_semi")


def fold_indices(
    df: DataFrame, folds: DataFrame, k: int, keys: Sequence[str], provider: str = S.PROVIDER
) -> DataFrame:
    """(fold, split, row keys): each row is `test` in its own fold and `train` in the k-1 others."""
    owned = df.select(*keys, *([] if provider in keys else [provider]))
    owned = owned.join(folds.select(provider, F.col("fold").alias("_own")), provider, "inner")
    every = F.explode(F.array(*[F.lit(i) for i in range(k)])).alias("fold")
    role = F.when(F.col("fold") == F.col("_own"), "test").otherwise("train")
    return owned.select(*keys, "_own", every).select("fold", role.alias("split"), *keys)


def fold_leaks(df: DataFrame, provider: str = S.PROVIDER) -> DataFrame:
    """Providers found in more than one fold; an empty result means no leakage."""
    per = df.groupBy(provider).agg(F.min("fold").alias("first_fold"), F.max("fold").alias("last_fold"))
    return per.filter("first_fold <> last_fold")


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Per-fold results one under the other, matched by column name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def assemble_scores(rows: DataFrame, scores: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Attach out-of-fold scores by row key; rows that no fold scored are left out."""
    for score in scores:
        rows = rows.join(score, list(keys), "inner")
    return rows
