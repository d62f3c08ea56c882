"""ANSI-safe coercions: a value that does not parse becomes NULL, it never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: published in place of small counts and amounts.
SUPPRESSED = "*"


def parse(text: Column, kind: str) -> Column:
    """try_cast with the common suppression mark sorted out first: a cast that fails raises and
    catches an exception for every such row, which costs far more than the cast itself."""
    return F.when(text != SUPPRESSED, text.try_cast(kind))


def to_double(c: Column) -> Column:
    return parse(c.cast("string"), "double")


def to_int(c: Column, width: str = "int") -> Column:
    """Text or number to an integer, truncating fractions towards zero; out of range gives NULL.

    The way through double also avoids failing casts: text such as 12.5 is no valid integer.
    """
    return to_double(c).try_cast(width)


def npi_key(c: Column) -> Column:
    """Provider ids need 64 bits: ten digits do not fit an int."""
    return to_int(F.trim(c.cast("string")), "bigint")


def strip_money(c: Column) -> Column:
    return F.translate(c.cast("string"), "$,", "")


def money(c: Column, kind: str = "float") -> Column:
    """`$1,234.50` to a number. `kind` may be float, double or a decimal type."""
    return parse(strip_money(c), kind)


def compact_date(c: Column) -> Column:
    """`yyyyMMdd` to a date; sentinels such as 0 and 00000000 become NULL."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def code(c: Column) -> Column:
    return F.lower(F.trim(c))


def guarded_ratio(numerator: Column, denominator: Column, default: float = 1.0) -> Column:
    """numerator / denominator, or `default` where the denominator is missing or zero."""
    usable = denominator.isNotNull() & (denominator != 0)
    return F.when(usable, F.try_divide(numerator, denominator)).otherwise(F.lit(default))
