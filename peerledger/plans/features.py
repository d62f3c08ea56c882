"""The feature table: claims, summaries and exclusions to a labelled, encoded training table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from peerledger import schemas as S
from peerledger.functions.hashing import key_text
from peerledger.operators import clean, encode, joins, labels, peers
from peerledger.operators.aggregate import CROWDED_ROWS, claim_statistics
from peerledger.session import stage

ROW_KEY = "row_key"


@dataclass(frozen=True)
class FeatureOptions:
    summary_mode: str = "typed"
    money_type: str = "float"
    drop_copies: bool = True
    check_summary_keys: bool = True
    fraud_codes: Sequence[str] = S.FRAUD_CODES
    metrics: Sequence[str] = S.PEER_METRICS
    categories: Mapping[str, Sequence[str]] | None = None
    on_collision: str = "or"
    layout: str = "auto"
    crowded_rows: int = CROWDED_ROWS
    row_key: bool = False


def staged_statistics(detail: DataFrame, options: FeatureOptions = FeatureOptions()) -> DataFrame:
    """Provider statistics, written once: they are read for the peer moments, for the categories
    and for the result, while the raw claims are scanned, deduplicated and grouped a single time."""
    made = claim_statistics(
        detail, options.money_type, options.drop_copies, options.layout, options.crowded_rows
    )
    return stage(made, "provider-stats")


def compared(stats: DataFrame, options: FeatureOptions = FeatureOptions()) -> DataFrame:
    return peers.risk_ratios(peers.peer_features(stats, options.metrics))


def provider_features(detail: DataFrame, options: FeatureOptions = FeatureOptions()) -> DataFrame:
    """Statistics, peer comparison and risk ratios per provider, year, specialty and place."""
    return compared(staged_statistics(detail, options), options)


def feature_table(
    detail: DataFrame,
    summary: DataFrame,
    exclusions: DataFrame,
    options: FeatureOptions = FeatureOptions(),
) -> DataFrame:
    """The labelled, encoded training table. Categories are those left after the summary join.

    With `row_key` it also has a column of that name, made of provider, year, specialty and place before the last two become flags:
    specialties whose flags share a column then still tell rows apart.
    """
    stats = staged_statistics(detail, options)
    if options.row_key:
        stats = stats.withColumn(ROW_KEY, key_text(S.GROUP_KEYS))
    tidy = clean.clean_summary(summary, options.summary_mode)
    keys = [S.PROVIDER, "year"]
    values = options.categories
    if values is None:
        values = encode.category_values(stats.join(tidy.select(*keys), keys, "left_semi"))
    enriched = joins.join_summary(compared(stats, options), tidy, check_unique=options.check_summary_keys)
    fraud = labels.fraud_exclusions(labels.clean_exclusions(exclusions), options.fraud_codes)
    flagged = labels.flag_providers(enriched, fraud)
    encoded = encode.one_hot(flagged, values=values, on_collision=options.on_collision)
    return encode.training_projection(encoded)


def row_keys(table: DataFrame) -> list[str]:
    """Columns that identify a row of the feature table: its row key if it has one, else provider, year and the category flags, which
    do so only where no two specialties of a provider share a flag."""
    if ROW_KEY in table.columns:
        return [ROW_KEY]
    return [S.PROVIDER, "year", *sorted(c for c in table.columns if "_ohe_" in c)]
