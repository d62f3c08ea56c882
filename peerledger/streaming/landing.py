"""Incremental landing of page files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.session import stage, staging
from peerledger.sources.pages import decode_parsed, parse_once, parsed_sizes, rejected_parsed
from peerledger.sources.sinks import land_batches


def land_page_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    fields: T.StructType,
    rows_per_file: int = S.LANDING_FILE_ROWS,
    files_per_trigger: int = 1000,
    rejected: str | None = None,
    progress: str | None = None,
) -> StreamingQuery:
    """Decode every page file not seen before and stop when the folder is drained.

    A corrupt page, or a line that is no page at all, stops the stream; once the file is mended or moved away, the next run goes on
    from there. With a folder `rejected`, such pages are set aside there with the name of their file, and the others land. With a
    folder `progress`, each micro-batch leaves its pages, records, rejected pages and reach per year there, for `read_progress` to sum up.

    Each micro-batch overwrites its own `batch=<id>` folder in all of them, so a batch replayed after a failure
    replaces what the first attempt left instead of adding to it.
    """
    pages = spark.readStream.schema(S.PAGE).option("maxFilesPerTrigger", files_per_trigger).json(source)
    if rejected is not None:
        pages = pages.select("*", F.col("_metadata.file_path").alias("file"))

    def write(batch: DataFrame, batch_id: int) -> None:
        with staging(spark):
            more = [] if rejected is None else ["file"]
            parsed = parse_once(batch, fields, more)
            if rejected is not None or progress is not None:  # several readers: a page is parsed once for all of them
                parsed = stage(parsed, "page-batch")
            if rejected is not None:
                rejected_parsed(parsed, more).write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
            if progress is not None:
                parsed_sizes(parsed).coalesce(1).write.mode("overwrite").parquet(f"{progress}/batch={batch_id}")
            rows = decode_parsed(parsed, fields, "raise" if rejected is None else "reject")
            land_batches(rows, f"{target}/batch={batch_id}", "year", rows_per_file, "overwrite")

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_progress(spark: SparkSession, progress: str) -> DataFrame:
    """(year, pages, records, rejected, reach, declared_total) of all runs so far; a year is complete when its records, and its reach,
    equal its declared total."""
    sums = [F.sum(c).alias(c) for c in ("pages", "records", "rejected")]
    return spark.read.parquet(progress).groupBy("year").agg(*sums, F.max("reach").alias("reach"), F.max("declared").alias("declared_total"))


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """Everything landed so far, whatever micro-batch brought it."""
    return spark.read.parquet(target).drop("batch")
