"""Comparison of a provider with its specialty."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.functions.coerce import guarded_ratio
from peerledger.functions.names import first_present, stat_column
from peerledger.operators.joins import bounded_broadcast


def resolve_metrics(columns: Sequence[str], metrics: Sequence[str]) -> dict[str, str]:
    """Metric name to the column it stands for; unknown metrics are left out with a warning."""
    found = {m: stat_column(columns, m) for m in metrics}
    unknown = [m for m, c in found.items() if c is None]
    if unknown:
        warnings.warn(f"no column for the metrics {unknown}: they are skipped", stacklevel=2)
    return {m: c for m, c in found.items() if c is not None}


def _moments(resolved: dict[str, str]) -> list[tuple[str, Column]]:
    return [
        pair
        for m, c in resolved.items()
        for pair in ((f"{m}_peer_mean", F.avg(c)), (f"{m}_peer_std", F.stddev_samp(c)))
    ]


def peer_moments(
    df: DataFrame, metrics: Sequence[str] = S.PEER_METRICS, group: str = S.SPECIALTY
) -> DataFrame:
    """One row per peer group: mean and raw sample deviation of every metric."""
    resolved = resolve_metrics(df.columns, metrics)
    return df.groupBy(group).agg(*[c.alias(n) for n, c in _moments(resolved)])


def with_peer_moments(
    df: DataFrame,
    metrics: Sequence[str] = S.PEER_METRICS,
    group: str = S.SPECIALTY,
    plan: str = "join",
) -> DataFrame:
    """Attach the peer moments to every row.

    plan="join": partial aggregation by group, then a null-safe join back. One specialty holding a
    third of the rows costs no more than the others, because rows are never moved by specialty.
    plan="window": the same result with one window; it sorts each specialty inside one task and is
    meant for moderate peer groups only.
    """
    resolved = resolve_metrics(df.columns, metrics)
    if plan == "window":
        peers = Window.partitionBy(group)
        return df.select("*", *[c.over(peers).alias(n) for n, c in _moments(resolved)])
    if plan != "join":
        raise ValueError(f"unknown plan {plan!r}")
    moments = bounded_broadcast(peer_moments(df, metrics, group).withColumnRenamed(group, "_peer_group"))
    return df.join(moments, df[group].eqNullSafe(moments["_peer_group"]), "inner").drop("_peer_group")


def peer_features(
    df: DataFrame,
    metrics: Sequence[str] = S.PEER_METRICS,
    group: str = S.SPECIALTY,
    plan: str = "join",
    keep_moments: bool = False,
) -> DataFrame:
    """z-score and ratio to the peer mean for every metric.

    A missing or zero deviation counts as 0.01; smaller positive deviations are used as they are.
    """
    resolved = resolve_metrics(df.columns, metrics)
    wide = with_peer_moments(df, metrics, group, plan)
    added = []
    for metric, source in resolved.items():
        x, mean, std = F.col(source), F.col(f"{metric}_peer_mean"), F.col(f"{metric}_peer_std")
        spread = F.when(std.isNull() | (std == 0), F.lit(S.FLAT_STD)).otherwise(std)
        added.append(((x - mean) / spread).alias(f"{metric}_zscore"))
        added.append(F.when(mean == 0, F.lit(1.0)).otherwise(F.try_divide(x, mean)).alias(f"{metric}_ratio"))
    kept = wide.columns if keep_moments else df.columns
    return wide.select(*kept, *added)


def risk_ratios(df: DataFrame) -> DataFrame:
    """Charge per payment and services per beneficiary, where the inputs exist."""

    def pick(raw: str) -> Column | None:
        base = S.MEASURES[raw]
        name = first_present(df.columns, (raw, f"{base}_sum", f"{base}_mean"))
        return None if name is None else F.col(name)

    wanted = {
        "billing_inflation": (pick("avg_sbmtd_chrg"), pick("avg_mdcr_pymt_amt")),
        "service_density": (pick("tot_srvcs"), pick("tot_benes")),
    }
    skipped = [n for n, (a, b) in wanted.items() if a is None or b is None]
    if skipped:
        warnings.warn(f"no columns for the ratios {skipped}: they are skipped", stacklevel=2)
    ready = {n: guarded_ratio(a, b) for n, (a, b) in wanted.items() if a is not None and b is not None}
    return df.withColumns(ready) if ready else df
