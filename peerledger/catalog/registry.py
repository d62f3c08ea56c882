"""Name -> (query, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so that summation order does not show in a value hash.

    Written as floating-point steps because the engines' own round() treats near-ties differently.
    """
    scale = F.lit(10.0**digits)

    def step(name: str):
        return (F.floor(F.col(name) * scale + F.lit(0.5)) / scale).alias(name)

    return df.select(*[step(f.name) if isinstance(f.dataType, T.DoubleType) else f.name for f in df.schema.fields])


def round_sql(columns: list[str], digits: int = 6) -> str:
    scale = f"cast(1e{digits} as double)"
    return ", ".join(
        f'floor(cast("{c}" as double) * {scale} + cast(0.5 as double)) / {scale} as "{c}"' for c in columns
    )
