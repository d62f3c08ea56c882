"""Removal of long repeated byte strings through a logarithmic family of sparse suffix arrays.

Every window of LENGTH bytes has an anchor: the place in it where the hash of the next PREFIX bytes is smallest. Equal windows have
their anchors at equal offsets, so only suffixes that start at anchors need an index: one for about every 70 bytes.

1. A batch of documents gets a suffix array: the hashes of its anchored suffixes' first PREFIX bytes, sorted, with counts. It is
   merge-scanned against every level of the index; suffixes met there, or twice in the batch, are repeated. Levels of equal size
   merge, so n batches leave at most log2(n) + 1 levels. Levels are bucketed tables: scans and merges are sort-merge joins
   without an exchange.
2. The windows of one anchor lie in one stretch of bytes. If a whole stretch occurs twice, all its windows are repeated.
3. The other stretches of repeated suffixes, mostly at the ends of repeated passages, send their bytes to the tasks of their
   core (the bytes common to up to CHUNK windows), where windows are compared one by one. Cores with very many stretches
   are compared by an aggregation over windows instead.
4. Windows that occur twice become spans of their document; the union of the spans is removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.llm.bits import bit_table, marked
from peerledger.llm.jaccard import STEP, mixed
from peerledger.session import fresh_path, stage, stage_counted

LENGTH = 200
PREFIX = 32
CHUNK = 96
BATCHES = 4
CROWDED = 512
TOGETHER = 8192  # stretches compared at a time, besides the rest of a core
SLICE_BYTES = 2_000_000
TABLE_BITS = 2**25


class Hashes:
    """Hashes of any stretches of a byte string."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        powers = np.full(len(raw) + 1, STEP, np.uint64)
        powers[0] = 1
        self.back = np.full(len(raw) + 1, pow(STEP, -1, 2**64), np.uint64)
        self.back[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.back, out=self.back)
        self.running = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=self.running[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.running[end] - self.running[begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, size = values, 1
    while size * 2 <= width:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    return np.minimum(least[: len(least) - (width - size)], least[width - size :]) if size < width else least


class Stretches:
    """The stretches of a slice of texts: text `owner`, `anchor`, and the windows `first` to `last` that it anchors, as places in the
    joined bytes; `base` is where each text begins."""

    def __init__(self, texts: Sequence[bytes], length: int, prefix: int):
        self.data = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.base = np.cumsum(sizes) - sizes
        none = np.zeros(0, np.int64)
        self.owner = self.anchor = self.first = self.last = none
        self.key = self.whole = np.zeros(0, np.uint64)
        if len(self.data) < length:
            return
        self.hashes = Hashes(self.data)
        begin = np.arange(len(self.data) - prefix + 1)
        heads = self.hashes.of(begin, begin + prefix)
        ranked = (heads >> np.uint64(32) << np.uint64(32)) | begin.astype(np.uint64)  # of equal hashes the first place
        anchors = (_sliding_least(ranked, length - prefix + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        of = np.repeat(np.arange(len(texts)), sizes)
        at = np.flatnonzero(of[: len(anchors)] == of[length - 1 : length - 1 + len(anchors)])
        if not len(at):
            return
        fresh = np.ones(len(at), bool)
        fresh[1:] = (anchors[at[1:]] != anchors[at[:-1]]) | (of[at[1:]] != of[at[:-1]])
        starts = np.flatnonzero(fresh)
        self.first, self.last = at[starts], at[np.append(starts[1:], len(at)) - 1]
        self.anchor, self.owner = anchors[self.first], of[self.first]
        self.key = heads[self.anchor]
        self.whole = mixed(self.hashes.of(self.first, self.last + length) + (self.anchor - self.first).astype(np.uint64) * np.uint64(STEP))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(row numbers, texts) in slices of about SLICE_BYTES; a longer text is alone."""
    for batch in batches:
        rows = batch.column(0).to_numpy()
        texts = batch.column(1).to_pylist()
        begin, size = 0, 0
        for i, text in enumerate(texts):
            if size and size + len(text) > SLICE_BYTES:
                yield rows[begin:i], texts[begin:i]
                begin, size = i, 0
            size += len(text)
        if begin < len(texts):
            yield rows[begin:], texts[begin:]


def _suffixes(batches: Iterator[pa.RecordBatch], length: int, prefix: int) -> Iterator[pa.RecordBatch]:
    for _, texts in _sliced(batches):
        found, counts = np.unique(Stretches(texts, length, prefix).key, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["key", "n"])


def _live(batches: Iterator[pa.RecordBatch], length: int, prefix: int, repeated) -> Iterator[pa.RecordBatch]:
    """Stretches whose suffix may be repeated: (key, whole, row, first, last), places inside the text."""
    for rows, texts in _sliced(batches):
        s = Stretches(texts, length, prefix)
        keep = marked(repeated.value, s.key)
        base = s.base[s.owner[keep]]
        columns = [s.key[keep].view(np.int64), s.whole[keep].view(np.int64), rows[s.owner[keep]], s.first[keep] - base, s.last[keep] - base]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "whole", "row", "first", "last"])


def _cores(batches: Iterator[pa.RecordBatch], length: int, prefix: int, chunk: int, open_ones) -> Iterator[pa.RecordBatch]:
    """(core, row, first, bytes) of the chunks of windows of the stretches that are to be compared window by window.

    A chunk holds the windows whose anchor lies k * chunk to (k + 1) * chunk - 1 bytes after their begin."""
    for rows, texts in _sliced(batches):
        s = Stretches(texts, length, prefix)
        mark = s.whole ^ rows[s.owner].astype(np.uint64)
        keep = np.flatnonzero(marked(open_ones.value, mark))
        if not len(keep):
            continue
        anchor, first, last, owner = s.anchor[keep], s.first[keep], s.last[keep], s.owner[keep]
        cores, names, places, parts = [], [], [], []
        for k in range(-(-(length - prefix + 1) // chunk)):
            low, high = k * chunk, min((k + 1) * chunk, length - prefix + 1) - 1
            begin, end = np.maximum(first, anchor - high), np.minimum(last, anchor - low)
            some = np.flatnonzero(begin <= end)
            # All windows of the chunk hold these bytes, whether this stretch has all of them or not.
            core = s.hashes.of(anchor[some] - low, anchor[some] - high + length)
            cores.append(mixed(core + np.uint64(k)))
            names.append(rows[owner[some]])
            places.append(begin[some] - s.base[owner[some]])
            parts += [s.data[a : b + length] for a, b in zip(begin[some].tolist(), end[some].tolist())]
        columns = [np.concatenate(cores).view(np.int64), np.concatenate(names), np.concatenate(places)]
        yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(parts, pa.binary())], ["core", "row", "first", "bytes"])


def _windows(rows: np.ndarray, first: np.ndarray, parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, begin) of every window of the given stretches."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    counts = sizes - length + 1
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.repeat(np.cumsum(sizes) - sizes, counts) + inside
    return Hashes(b"".join(parts)).of(begin, begin + length), np.repeat(rows, counts), np.repeat(first, counts) + inside


def _spans(rows: np.ndarray, begin: np.ndarray, length: int) -> pa.Table:
    """Runs of neighbouring windows of a row as (row, begin, end)."""
    order = np.lexsort((begin, rows))
    rows, begin = rows[order], begin[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (begin[1:] != begin[:-1] + 1)
    starts = np.flatnonzero(fresh)
    last = begin[np.append(starts[1:], len(rows)) - 1] if len(rows) else begin
    return pa.table([pa.array(rows[starts]), pa.array(begin[starts]), pa.array(last + length)], ["row", "begin", "end"])


def _compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by core; whole cores are compared together, many at a time."""
    held: list[pa.RecordBatch] = []

    def compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        _, number, counts = np.unique(rows.column("core").to_numpy(), return_inverse=True, return_counts=True)
        rows = rows.filter(pa.array(counts[number] > 1))  # equal windows have equal cores
        if rows.num_rows:
            hashes, names, begin = _windows(rows.column("row").to_numpy(), rows.column("first").to_numpy(), rows.column("bytes").to_pylist(), length)
            _, number, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            again = counts[number] > 1
            yield from _spans(names[again], begin[again], length).to_batches()

    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            held.append(batch.slice(at, TOGETHER))
            if sum(b.num_rows for b in held) >= TOGETHER:
                rows = pa.Table.from_batches(held)
                cores = rows.column("core").to_numpy()
                whole = int(np.searchsorted(cores, cores[-1]))  # the last core may go on
                yield from compared(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
    if held:
        yield from compared(pa.Table.from_batches(held))


def _window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _windows(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist(), length)
        columns = [found[0].view(np.int64), found[1], found[2]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["window", "row", "begin"])


class SuffixIndex:
    """The levels. `add` returns the suffixes of a batch that are repeated in it or in what was added before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.levels = spark, []  # (batches, table), the largest first
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"suffixes_{uuid.uuid4().hex}"

    def _write(self, suffixes: DataFrame, batches: int) -> tuple[int, str]:
        table = f"{self.name}_{uuid.uuid4().hex[:8]}"
        suffixes.write.bucketBy(self.buckets, "key").sortBy("key").format("parquet").saveAsTable(table)
        return batches, table

    def add(self, suffixes: DataFrame) -> DataFrame:
        """`suffixes`: (key, n) of a batch, keys unique."""
        new = self._write(suffixes, 1)
        array = self.spark.table(new[1])
        found = array.filter("n > 1").select("key")
        for _, level in self.levels:
            found = found.union(array.join(self.spark.table(level).select("key").hint("merge"), "key", "left_semi").select("key"))
        found = stage(found, "repeated-suffixes")
        self.levels.append(new)
        while len(self.levels) > 1 and self.levels[-1][0] >= self.levels[-2][0]:
            (a, left), (b, right) = self.levels.pop(), self.levels.pop()
            both = self.spark.table(left).join(self.spark.table(right).hint("merge").withColumnRenamed("n", "m"), "key", "full")
            summed = (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n")
            self.levels.append(self._write(both.select("key", summed), a + b))
            for table in (left, right):
                self.spark.sql(f"drop table {table}")
        return found

    def drop(self) -> None:
        for _, table in self.levels:
            self.spark.sql(f"drop table if exists {table}")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text without its spans, and the spans, joined and in order."""
    for batch in batches:
        kept, spans = [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            joined: list[dict] = []
            for span in sorted(found or [], key=lambda s: s["begin"]):
                if joined and span["begin"] <= joined[-1]["end"]:
                    joined[-1]["end"] = max(joined[-1]["end"], span["end"])
                else:
                    joined.append(dict(span))
            edges = [0, *(e for s in joined for e in (s["begin"], s["end"])), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans.append(joined)
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        columns = [batch.column(0), pa.array([len(t) for t in batch.column(1).to_pylist()], pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "n_bytes", "spans", "kept"])


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[Column] | None = None,
    length: int = LENGTH,
    prefix: int = PREFIX,
    batches: int = BATCHES,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per document: (doc, n_bytes, spans, kept).

    `spans` are the maximal runs of bytes that some string of `length` bytes covers which also starts anywhere else, in the same
    document or another; `kept` is the rest, as bytes, since a span may cut a character. Strings never cross documents and are
    judged on the input. A NULL text is empty; texts shorter than `length` keep everything; of repeated rows every one loses
    what they share. `doc` holds the columns of `docs`, or `carry`. An empty table gives an empty result. A text must fit a task.
    """
    spark = docs.sparkSession
    doc = F.struct(*(carry or [F.col(f"`{c}`") for c in docs.columns])).alias("doc")
    content = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text")
    path = fresh_path(spark, "numbered-documents")
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), doc, content)
    numbered = numbered.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int"))
    numbered.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path)
    read = rows.select("row", "text")

    index = SuffixIndex(spark)
    repeated = None
    for b in range(batches):
        batch = rows.filter(F.col("batch") == b).select("row", "text")
        arrays = batch.mapInArrow(partial(_suffixes, length=length, prefix=prefix), "key bigint, n bigint")
        found = index.add(arrays.groupBy("key").agg(F.sum("n").alias("n")))
        repeated = found if repeated is None else repeated.union(found)
    repeated = stage(repeated.distinct(), "repeated-suffixes")
    index.drop()

    shared = spark.sparkContext.broadcast(bit_table(repeated, TABLE_BITS))
    live = read.mapInArrow(
        partial(_live, length=length, prefix=prefix, repeated=shared), "key bigint, whole bigint, row bigint, first bigint, last bigint"
    )
    live = stage(live.join(repeated, "key", "left_semi"), "live-stretches")
    often = stage(live.groupBy("whole").agg(F.count("*").alias("times"), F.min("row").alias("model")), "stretch-counts")
    counted = stage(live.join(often, "whole"), "counted-stretches")
    whole_spans = counted.filter("times > 1").select("row", F.col("first").alias("begin"), (F.col("last") + length).alias("end"))

    # Compared window by window: stretches that occur once, and one model of each other stretch with a suffix of theirs.
    single = counted.filter("times = 1")
    suffixes = stage(single.select("key").distinct(), "open-suffixes")
    models = counted.filter("times > 1 and row = model").join(suffixes, "key", "left_semi")
    mark = F.col("whole").bitwiseXOR(F.col("row")).alias("mark")
    open_ones = spark.sparkContext.broadcast(bit_table(single.select(mark).union(models.select(mark)), TABLE_BITS))
    task = partial(_cores, length=length, prefix=prefix, chunk=CHUNK, open_ones=open_ones)
    cores, count = stage_counted(read.mapInArrow(task, "core bigint, row bigint, first bigint, bytes binary"), "window-chunks")
    spans = whole_spans
    if count:
        hot, hot_ones = stage_counted(cores.groupBy("core").count().filter(F.col("count") > crowded).select("core"), "crowded-cores")
        calm = cores.join(hot, "core", "left_anti") if hot_ones else cores
        calm = calm.repartition("core").sortWithinPartitions("core")
        found = calm.mapInArrow(partial(_compare, length=length), "row bigint, begin bigint, end bigint")
        spans = spans.union(found)
        if hot_ones:
            crowd = cores.join(hot, "core", "left_semi").select("row", "first", "bytes")
            windows = stage(crowd.mapInArrow(partial(_window_rows, length=length), "window bigint, row bigint, begin bigint"), "crowded-windows")
            again = stage(windows.groupBy("window").count().filter("count > 1").select("window"), "repeated-windows")
            met = windows.join(again, "window", "left_semi")
            spans = spans.union(met.select("row", "begin", (F.col("begin") + length).alias("end")))
    listed = spans.groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = rows.select("row", "doc", "text").join(listed, "row", "left").select("doc", "text", "spans")
    schema = T.StructType(
        [
            rows.schema["doc"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    return joined.mapInArrow(_cut, schema)

