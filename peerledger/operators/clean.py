"""Detail and summary cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger import schemas as S
from peerledger.functions import coerce
from peerledger.functions.names import lower_names


def impute_missing(c: Column, value: object) -> Column:
    """Fill only what was absent in the raw data; text that fails to parse later stays NULL."""
    return F.coalesce(c, F.lit(value))


def merge_aliases(c: Column, aliases: Mapping[str, str] = S.SPECIALTY_ALIASES) -> Column:
    merged = F.when(F.lit(False), c)
    for spelling, canonical in aliases.items():
        merged = merged.when(c == spelling, canonical)
    return merged.otherwise(c)


def comparable_detail(
    df: DataFrame, money_type: str = "float", aliases: Mapping[str, str] = S.SPECIALTY_ALIASES
) -> DataFrame:
    """Raw claim lines in the form in which copies are recognised.

    Identity columns are gone, currency is numeric and specialties are merged, so `$1,000` and
    `1000` are the same line. Counts are still text: two lines that differ only in an unparseable
    count are different lines. The typed keys stand beside the raw ones as `_npi` and `_year`.
    """
    df = lower_names(df).withColumnsRenamed(S.DETAIL_RENAMES).drop(*S.DETAIL_DROPPED)
    made = {c: coerce.money(F.col(c), money_type) for c in S.MONEY_COLUMNS if c in df.columns}
    made["tot_benes"] = impute_missing(F.col("tot_benes").cast("string"), str(S.MISSING_BENEFICIARIES))
    made[S.SPECIALTY] = merge_aliases(F.col(S.SPECIALTY).cast("string"), aliases)
    made["_npi"] = coerce.npi_key(F.col(S.PROVIDER))
    made["_year"] = coerce.to_int(F.col("year"))
    return df.withColumns(made)


def typed_detail(df: DataFrame) -> DataFrame:
    """Comparable lines to typed lines."""
    made = {c: coerce.to_int(F.col(c)) for c in S.COUNT_COLUMNS if c in df.columns}
    keys = {S.PROVIDER: F.col("_npi"), "year": F.col("_year")}
    made |= keys
    return df.withColumns(made).drop("_npi", "_year")


def clean_detail(
    df: DataFrame,
    money_type: str = "float",
    distinct: bool = True,
    aliases: Mapping[str, str] = S.SPECIALTY_ALIASES,
) -> DataFrame:
    """Raw claim lines to typed, distinct claim lines.

    The distinct runs as a two-step hash aggregate: copies collapse inside each map task first, so
    a line repeated a billion times reaches the shuffle once per task.
    """
    lines = comparable_detail(df, money_type, aliases)
    return typed_detail(lines.dropDuplicates() if distinct else lines)


def numeric_view(
    df: DataFrame, columns: Sequence[str] | None = None, fill: float | None = 0.0
) -> DataFrame:
    """Strip currency marks, cast to double, optionally fill NULLs.

    Without `columns`, every string and plain numeric column is converted.
    """
    castable = (T.StringType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if columns is None:
        chosen = {f.name for f in df.schema.fields if isinstance(f.dataType, castable)}
    else:
        chosen = set(columns)

    def convert(name: str) -> Column:
        if name not in chosen:
            return F.col(name)
        value = coerce.money(F.col(name), "double")
        return (value if fill is None else F.coalesce(value, F.lit(fill))).alias(name)

    return df.select(*[convert(c) for c in df.columns])


def clean_summary(
    df: DataFrame, mode: str = "typed", categorical: Sequence[str] = ("rndrng_prvdr_ent_cd", "rndrng_prvdr_mdcr_prtcptg_ind", S.SPECIALTY)
) -> DataFrame:
    """Provider summaries to join-ready rows.

    mode="typed" turns numeric columns, and text columns whose names say that they hold numbers, into doubles without NULLs; other
    text, and the columns named in `categorical`, stay. mode="parity" turns every text column into a number, which makes
    real categoricals constant 0.0. Dates, booleans and nested columns stay in either mode.
    """
    if mode not in ("typed", "parity"):
        raise ValueError(f"unknown mode {mode!r}")
    df = lower_names(df).drop(*S.SUMMARY_DROPPED)
    keys = {S.PROVIDER, "year"}
    kept = keys | (set(categorical) if mode == "typed" else set())

    def is_number(field: T.StructField) -> bool:
        text = isinstance(field.dataType, T.StringType) and (mode == "parity" or field.name.startswith(S.SUMMARY_NUMBERS))
        return field.name not in kept and (text or isinstance(field.dataType, T.NumericType))

    df = numeric_view(df, [f.name for f in df.schema.fields if is_number(f)])
    provider = coerce.npi_key(F.col(S.PROVIDER))
    year = coerce.to_int(F.col("year"))
    if mode == "parity":
        provider, year = F.coalesce(provider, F.lit(0).cast("bigint")), F.coalesce(year, F.lit(0))
    return df.withColumns({S.PROVIDER: provider, "year": year})


def audit_nulls(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: NULL count per required column. A missing column is an error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in required])
