"""Plan-time column-name helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a category value becomes inside a one-hot column name.
TO_UNDERSCORE = " /-"
REMOVED = "(),.'"
AMPERSAND = "and"
NAME_LIMIT = 50


def lower_names(df: DataFrame) -> DataFrame:
    lowered = [c.lower() for c in df.columns]
    clashes = sorted({c for c in lowered if lowered.count(c) > 1})
    if clashes:
        raise ValueError(f"columns differ only by case: {clashes}")
    return df.toDF(*lowered)


def first_present(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    available = set(columns)
    return next((c for c in candidates if c in available), None)


def stat_column(columns: Iterable[str], base: str) -> str | None:
    """The column a metric name stands for: itself, else its sum, else its mean."""
    return first_present(columns, (base, base + "_sum", base + "_mean"))


def label_text(value: object) -> str:
    table = str.maketrans(dict.fromkeys(TO_UNDERSCORE, "_") | dict.fromkeys(REMOVED, "") | {"&": AMPERSAND})
    return str(value).translate(table)[:NAME_LIMIT]


def label_column(c: Column) -> Column:
    """The same rule as `label_text`, applied to a column of values."""
    swapped = F.translate(c, TO_UNDERSCORE + REMOVED, "_" * len(TO_UNDERSCORE))
    return F.substring(F.replace(swapped, F.lit("&"), F.lit(AMPERSAND)), 1, NAME_LIMIT)
