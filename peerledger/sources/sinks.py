"""Writers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.session import delete_path


#: Formats whose target is a folder of files, which can be written aside and swapped in.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def write_table(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    as_table: bool = False,
) -> int:
    """Overwrite `target` and return the rows written, counted by the write job itself.

    The rows are written aside and swapped in when all of them are there: a failed write leaves the former table as it was, and the table
    may be read by the very plan that overwrites it. Other formats than files are overwritten in their own way.
    """
    spark = df.sparkSession
    seen = Observation("written rows")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    mark = uuid.uuid4().hex
    if as_table:
        _swap_table(counted, target, f"{target}_{mark}", fmt, options or {})
    elif fmt in FILE_FORMATS:
        aside = f"{target.rstrip('/')}.{mark}"
        try:
            counted.write.mode("error").format(fmt).options(**(options or {})).save(aside)
        except Exception:
            delete_path(spark, aside)
            raise
        swap_in(spark, aside, target.rstrip("/"))
    else:
        counted.write.mode("overwrite").format(fmt).options(**(options or {})).save(target)
    return seen.get["rows"]


def _swap_table(df: DataFrame, target: str, aside: str, fmt: str, options: Mapping[str, str]) -> None:
    spark = df.sparkSession
    try:
        df.write.mode("error").format(fmt).options(**options).saveAsTable(aside)
    except Exception:
        spark.sql(f"drop table if exists {aside}")
        raise
    spark.sql(f"drop table if exists {target}")
    spark.sql(f"alter table {aside} rename to {target}")


def swap_in(spark: SparkSession, aside: str, target: str) -> None:
    """Put the folder `aside` in the place of `target`. The former folder keeps a name of its own until the new one is in place, and comes
    back if that fails."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    former = f"{aside}.former"
    had = store.exists(path(target))
    if had and not store.rename(path(target), path(former)):
        raise OSError(f"cannot move {target}")
    if not store.rename(path(aside), path(target)):
        if had:
            store.rename(path(former), path(target))
        raise OSError(f"cannot move {aside} to {target}")
    if had:
        store.delete(path(former), True)


def land_batches(
    df: DataFrame,
    path: str,
    partition: str = "year",
    rows_per_file: int = S.LANDING_FILE_ROWS,
    mode: str = "append",
) -> None:
    """Fixed-size parquet files under one folder per year.

    The rebalance hint lets adaptive execution split a year that holds most of the rows over many
    writers and merge small ones, so neither one huge task nor thousands of tiny files appear.
    """
    evened = df.hint("rebalance", partition)
    writer = evened.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(partition).parquet(path)
