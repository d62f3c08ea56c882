"""Exclusion list to labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.functions import coerce
from peerledger.functions.names import lower_names
from peerledger.operators.joins import BROADCAST_ROWS, bounded_broadcast


def valid_npi(c: Column) -> Column:
    return coerce.npi_key(c) > 0


def clean_exclusions(df: DataFrame) -> DataFrame:
    """Keep rows with a usable provider id; normalise code and dates."""
    df = lower_names(df).filter(valid_npi(F.col("npi")))
    excluded = coerce.compact_date(F.col("excldate"))
    return df.withColumns(
        {
            "npi": coerce.npi_key(F.col("npi")),
            "excldate_parsed": excluded,
            "excl_year": F.year(excluded),
            "reindate_parsed": coerce.compact_date(F.col("reindate")),
            "excltype": coerce.code(F.col("excltype")),
        }
    )


def fraud_exclusions(exclusions: DataFrame, codes: Sequence[str] = S.FRAUD_CODES) -> DataFrame:
    """Distinct fraud-related exclusions of a cleaned list."""
    chosen = exclusions.filter(F.col("excltype").isin(*codes))
    return chosen.select("npi", "excl_year", "reindate_parsed").distinct()


def flag_providers(df: DataFrame, fraud: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """0/1 label: does the provider occur in the fraud list, in whatever year?"""
    marked = fraud.select(F.col("npi").alias("_npi")).distinct().withColumn("_hit", F.lit(1))
    marked = bounded_broadcast(marked, broadcast_rows)
    joined = df.join(marked, df[S.PROVIDER] == marked["_npi"], "left")
    return joined.withColumn(S.LABEL, F.coalesce("_hit", F.lit(0))).drop("_npi", "_hit")


def flag_providers_as_of(
    df: DataFrame, fraud: DataFrame, years: Sequence[int], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Label only the claim years that lie inside [exclusion year, reinstatement year).

    Each exclusion is written out as the claim years it covers, so the range condition becomes an
    equality on (provider, year) with unique keys and no row is multiplied. `years` are the claim
    years of the table; rows of any other year are labelled 0.
    """
    reinstated = F.year("reindate_parsed")
    covered = F.filter(
        F.array(*[F.lit(int(y)) for y in sorted(set(years))]),
        lambda y: (y >= F.col("excl_year")) & (reinstated.isNull() | (y < reinstated)),
    )
    pairs = fraud.select(F.col("npi").alias("_npi"), F.explode(covered).alias("_year")).distinct()
    pairs = bounded_broadcast(pairs.withColumn("_hit", F.lit(1)), broadcast_rows)
    same = (df[S.PROVIDER] == pairs["_npi"]) & (df["year"] == pairs["_year"])
    joined = df.join(pairs, same, "left")
    return joined.withColumn(S.LABEL, F.coalesce("_hit", F.lit(0))).drop("_npi", "_year", "_hit")


def class_distribution(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Rows, positives and their share in one pass; the share of an empty table is 0."""
    positives = F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0).cast("bigint"))
    return df.agg(
        F.count("*").alias("total_count"),
        positives.alias("fraud_count"),
        F.coalesce(F.avg(F.col(label).cast("double")), F.lit(0.0)).alias("fraud_ratio"),
    )


def distinct_positive(
    df: DataFrame, label: str = S.LABEL, provider: str = S.PROVIDER, approximate: bool = False
) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.filter(F.col(label) == 1).agg(count(F.col(provider)).alias("fraud_providers"))


def provider_labels(df: DataFrame, label: str = S.LABEL, provider: str = S.PROVIDER) -> DataFrame:
    """One row per provider: 1 if any of its rows is positive."""
    known = df.filter(F.col(provider).isNotNull())
    return known.groupBy(provider).agg(F.max(label).alias(label))
