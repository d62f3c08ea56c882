"""Landed API pages: decoding and completeness audit.

A page is (year, offset, payload); the payload is a JSON list of records or an object with the
records under `data` and the declared total under `meta.totalCount`. Any other payload, NULL included, is a corrupt page: decoding
raises unless told to leave such pages to `rejected_pages`, and the audit counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger import schemas as S
from peerledger.functions.hashing import leading_bits
from peerledger.operators.ranking import BUCKET, GROUP, grouped, with_next, with_offsets
from peerledger.session import stage

PAGES_PER_BUCKET = 1024
BROKEN = "_broken"
SIZE = "_size"


def _text_fields(fields: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in fields.fields])


def _parsed(pages: DataFrame, fields: T.StructType, more: Sequence[str] = ()) -> DataFrame:
    """Pages with `records` (array of text structs; NULL on a corrupt page), `declared` and the payload. Each is parsed once."""
    record = T.ArrayType(_text_fields(fields))
    meta = T.StructType([T.StructField("totalCount", T.LongType())])
    # A page that breaks off after its records still yields them; the text of a broken page shows in a column of its own.
    envelope = T.StructType([T.StructField("data", record), T.StructField("meta", meta), T.StructField(BROKEN, T.StringType())])
    bare = F.substring(F.ltrim(F.col("payload")), 1, 1) == "["
    wrapped = F.when(
        bare,
        F.struct(
            F.from_json("payload", record).alias("data"),
            F.lit(None).cast(meta).alias("meta"),
            F.lit(None).cast("string").alias(BROKEN),
        ),
    ).otherwise(F.from_json("payload", envelope, {"columnNameOfCorruptRecord": BROKEN}))
    return pages.select("year", "offset", "payload", *more, wrapped.alias("page")).select(
        "year",
        "offset",
        F.when(F.col(f"page.{BROKEN}").isNull(), F.col("page.data")).alias("records"),
        F.col("page.meta.totalCount").alias("declared"),
        "payload",
        *more,
    )


def _size() -> Column:
    return F.when(F.col("records").isNotNull(), F.size("records"))


def parse_once(pages: DataFrame, fields: T.StructType, more: Sequence[str] = ()) -> DataFrame:
    """Pages ready to be written once and read by `decode_parsed`, `rejected_parsed` and `parsed_sizes`: the payload stays only where it
    is corrupt, and the size stands beside the records, so that rejected pages and sums do not read them."""
    parsed = _parsed(pages, fields, more)
    return parsed.withColumns({SIZE: _size(), "payload": F.when(F.col("records").isNull(), F.col("payload"))})


def decode_pages(pages: DataFrame, fields: T.StructType, corrupt: str = "raise") -> DataFrame:
    """One row per record: year plus the declared fields in their declared types.

    corrupt="raise" fails on the first corrupt page; corrupt="reject" leaves them out, for `rejected_pages` to return.
    """
    if corrupt not in ("raise", "reject"):
        raise ValueError(f"unknown treatment {corrupt!r}")
    return decode_parsed(_parsed(pages, fields), fields, corrupt)


def decode_parsed(parsed: DataFrame, fields: T.StructType, corrupt: str = "raise") -> DataFrame:
    """The same of pages parsed before."""
    if corrupt == "raise":
        where = F.concat(F.lit("corrupt page: year "), F.coalesce(F.col("year").cast("string"), F.lit("?")), F.lit(", offset "), F.coalesce(F.col("offset").cast("string"), F.lit("?")))
        none = F.raise_error(where).cast(parsed.schema["records"].dataType)
        parsed = parsed.withColumn("records", F.when(F.col("records").isNull(), none).otherwise(F.col("records")))
    rows = parsed.select("year", F.explode("records").alias("r"))
    return rows.select("year", *[F.col("r")[f.name].try_cast(f.dataType).alias(f.name) for f in fields.fields])


def rejected_pages(pages: DataFrame, fields: T.StructType, more: Sequence[str] = ()) -> DataFrame:
    """(year, offset, payload, ...) of the corrupt pages, with more columns of theirs where asked for."""
    return rejected_parsed(_parsed(pages, fields, more), more)


def rejected_parsed(parsed: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The same of pages parsed before."""
    sound = SIZE if SIZE in parsed.columns else "records"
    return parsed.filter(F.col(sound).isNull()).select("year", "offset", "payload", *more)


def page_sizes(pages: DataFrame, fields: T.StructType) -> DataFrame:
    """(year, pages, records, rejected, reach, declared): sums over the pages of each year; reach is where the furthest sound page ends."""
    return parsed_sizes(_parsed(pages, fields).withColumn(SIZE, _size()))


def parsed_sizes(parsed: DataFrame) -> DataFrame:
    """The same of pages parsed before, whose sizes are NULL on corrupt pages."""
    sound, size = F.col(SIZE).isNotNull(), F.col(SIZE).cast("bigint")
    return parsed.groupBy("year").agg(
        F.count_if(sound).alias("pages"),
        F.coalesce(F.sum(F.when(sound, size)), F.lit(0).cast("bigint")).alias("records"),
        F.count_if(~sound).alias("rejected"),
        F.max(F.when(sound, F.col("offset") + size)).alias("reach"),
        F.max(F.when(sound, F.col("declared"))).alias("declared"),
    )


def _content(records: Column, fields: T.StructType) -> Column:
    """Sum of record hashes: independent of the order of records and of page boundaries."""

    def one(r: Column) -> Column:
        text = F.concat_ws("|", *[F.coalesce(r[f.name], F.lit("~")) for f in fields.fields])
        return leading_bits(F.md5(text.cast("binary"))).cast("decimal(38,0)")

    zero = F.lit(0).cast("decimal(38,0)")
    return F.aggregate(records, zero, lambda acc, r: (acc + one(r)).cast("decimal(38,0)"))


def _covered(starts: DataFrame, page_rows: int) -> DataFrame:
    """(year, pos, step, cover, group, bucket): how many pages cover the positions from `pos` on, at each place where that may change."""
    start = F.struct(F.col("offset").alias("pos"), F.lit(1).cast("bigint").alias("step"))
    end = F.struct((F.col("offset") + F.col("reach")).alias("pos"), F.lit(-1).cast("bigint").alias("step"))
    marks = starts.select("year", F.explode(F.array(start, end)).alias("m")).select("year", "m.*")
    steps = grouped(marks.groupBy("year", "pos").agg(F.sum("step").alias("step")), ["year"])
    steps = steps.withColumn(BUCKET, F.floor(F.col("pos") / (page_rows * PAGES_PER_BUCKET)))
    placed = with_offsets(steps, {"_before": F.sum("step")})
    inside = Window.partitionBy(GROUP, BUCKET).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn("cover", F.col("_before") + F.sum("step").over(inside))


def page_breaks(pages: DataFrame, fields: T.StructType, page_rows: int = S.LANDING_BATCH_ROWS) -> DataFrame:
    """(year, kind, start, end): the positions [start, end) that no sound page holds (kind "gap", the list to fetch again) or that several
    pages from different starts hold ("overlap").

    A year that does not start at 0 or ends before its declared total has a gap there, and one without any record has one gap, to its
    declared total where a page tells it, else without an end. Corrupt pages hold nothing, so they show as gaps.
    """
    parsed = _parsed(pages, fields)
    size = F.size("records").cast("bigint")
    years = parsed.groupBy("year").agg(F.max(F.when(F.col("records").isNotNull(), F.col("declared"))).alias("declared"))
    held = parsed.filter(F.size("records") > 0).groupBy("year", "offset").agg(F.max(size).alias("reach"))
    covered = stage(_covered(stage(held, "page-starts"), page_rows), "page-cover")
    before = F.col("cover") - F.col("step")
    found = []
    for kind, able, was in (("gap", F.col("cover") == 0, before == 0), ("overlap", F.col("cover") > 1, before > 1)):
        changes = with_next(covered.withColumns({"_is": able, "_was": was}).filter("_is <> _was"), "pos", "end")
        found.append(changes.filter("_is").select("year", F.lit(kind).alias("kind"), F.col("pos").alias("start"), "end").filter("end is not null"))
    extent = covered.groupBy("year").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    edges = years.join(extent, "year", "left")
    gap, none = F.lit("gap").alias("kind"), F.lit(0).cast("bigint")
    # A first page that starts late: its gap is no change of cover, since nothing comes before it.
    head = edges.filter("first > 0 or first is null").select("year", gap, none.alias("start"), F.coalesce("first", "declared").alias("end"))
    tail = edges.filter("declared > last").select("year", gap, F.col("last").alias("start"), F.col("declared").alias("end"))
    return found[0].union(found[1]).union(head).union(tail)


def audit_pages(
    pages: DataFrame, fields: T.StructType, page_rows: int = S.LANDING_BATCH_ROWS
) -> DataFrame:
    """Per year: sound pages, records, declared total, gaps, overlaps, repeated and early short pages, corrupt pages, content
    digest, and the earliest year with identical content.

    Every sound page adds 1 where it starts and takes 1 away where it ends, so the running sum says how many pages cover a position:
    0 before the last end is a gap (one more if the first page does not start at 0), 2 or more is an overlap, unless the
    pages start at the same place, which is a repeated page. A year whose pages are all corrupt or empty stays in the result.
    Positions are buckets of pages, so the running sum has no window over a year.
    """
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    parsed = _parsed(pages, fields)
    every = parsed.groupBy("year").agg(F.count_if(F.col("records").isNull()).alias("corrupt_pages"))
    size = F.size("records").cast("bigint")
    read = parsed.filter(F.size("records") > 0).select(
        "year",
        "offset",
        size.alias("size"),
        "declared",
        _content(F.col("records"), fields).alias("content"),
    )
    # Pages that start together are one place; the longest of them decides how far it reaches.
    starts = read.groupBy("year", "offset").agg(
        F.count("*").alias("pages"),
        F.max("size").alias("reach"),
        F.sum("size").alias("records"),
        F.sum((F.col("size") < page_rows).cast("bigint")).alias("short"),
        F.max("declared").alias("declared"),
        F.sum("content").alias("content"),
    )
    starts = stage(starts, "page-starts")
    covered = _covered(starts, page_rows)
    breaks = covered.groupBy("year").agg(
        (F.count_if(F.col("cover") == 0) - 1 + (F.min("pos") > 0).cast("bigint")).alias("gaps"),
        F.sum(F.when((F.col("cover") > 1) & (F.col("step") > 0), 1).otherwise(0)).cast("bigint").alias("overlaps"),
    )
    last_short = F.max_by(F.col("short"), F.col("offset"))
    sums = starts.groupBy("year").agg(
        F.sum("pages").alias("pages"),
        F.sum("records").alias("records"),
        F.max("declared").alias("declared_total"),
        F.sum(F.col("pages") - 1).alias("repeated_pages"),
        (F.sum("short") - F.least(last_short, F.lit(1).cast("bigint"))).alias("early_short_pages"),
        F.sum("content").alias("digest"),
    )
    years = every.join(sums, "year", "left").join(breaks, "year", "left")
    same = sums.groupBy("digest", "records").agg(F.min("year").alias("first_year"))
    joined = years.join(same, ["digest", "records"], "left")
    counts = ("pages", "records", "gaps", "overlaps", "repeated_pages", "early_short_pages")
    return joined.select(
        "year",
        *[F.coalesce(c, zero).alias(c) for c in counts],
        F.coalesce("declared_total", none).alias("declared_total"),
        "corrupt_pages",
        F.col("digest").cast("string").alias("digest"),
        F.when(F.col("first_year") < F.col("year"), F.col("first_year")).alias("same_content_as"),
    )
