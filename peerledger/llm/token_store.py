"""Token ids on disk as wavelet matrices.

Documents are sorted by key into shards; a shard is written as chunks of whole documents, each a wavelet matrix: one plane of
bits per bit of an id, from the highest down, each id moving behind the others where its bit is 1, with the number of zeros of each
plane and a directory of ones per 2048 bits. A chunk answers access, rank, select and range counts from its compressed row; all
ids are read back by undoing the planes. The table holds per chunk: shard, chunk, keys, tokens (of each document), size, zeros,
planes, ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.llm.words import WORD, encoder, flat_ids, lower_normal, slices, split_words, spread

CHUNK_TOKENS = 4_000_000
SLICE_CHARS = 2_000_000
DIRECTORY_BITS = 2048


class WaveletMatrix:
    """Ids of a chunk; `planes` holds the bit planes end to end, each padded to whole bytes."""

    def __init__(self, size: int, zeros: Sequence[int], planes: bytes, ones: bytes):
        self.size, self.zeros = size, list(zeros)
        self.planes = np.frombuffer(planes, np.uint8).reshape(len(self.zeros), -1)
        self.ones = np.frombuffer(ones, "<u4").reshape(len(self.zeros), -1)

    @staticmethod
    def of(ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = [], []
        step = DIRECTORY_BITS // 8
        width = -(-len(ids) // 8)
        ones = np.zeros((bits, width // step + 1), "<u4")
        for level in range(bits):
            set_bits = ((ids >> (bits - 1 - level)) & 1).astype(bool)
            plane = np.packbits(set_bits)
            counts = np.bitwise_count(plane)
            padded = np.zeros((width // step + 1) * step, np.uint8)
            padded[:width] = counts
            ones[level, 1:] = np.cumsum(padded.reshape(-1, step).sum(axis=1, dtype=np.uint32))[:-1]
            low = ids[~set_bits]
            ids = np.concatenate((low, ids[set_bits]))
            planes.append(plane.tobytes())
            zeros.append(len(low))
        return WaveletMatrix(len(ids), zeros, b"".join(planes), ones.tobytes())

    def _rank1(self, level: int, at: int) -> int:
        """Ones of a plane before position `at`."""
        block, step = at // DIRECTORY_BITS, DIRECTORY_BITS // 8
        row, whole = self.planes[level], at // 8
        count = int(self.ones[level, block]) + int(np.bitwise_count(row[block * step : whole]).sum())
        return count + (int(row[whole] >> (8 - at % 8)).bit_count() if at % 8 else 0)

    def access(self, at: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level, at // 8] >> (7 - at % 8)) & 1
            value = 2 * value + bit
            ones = self._rank1(level, at)
            at = zeros + ones if bit else at - ones
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        bits = len(self.zeros)
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, begin), self._rank1(level, end)
            begin, end = (zeros + a, zeros + b) if (token >> (bits - 1 - level)) & 1 else (begin - a, end - b)
        return begin, end

    def rank(self, token: int, at: int) -> int:
        """Occurrences of a token before position `at`."""
        if token >> len(self.zeros):
            return 0
        begin, end = self._range(token, 0, at)
        return end - begin

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token; -1 if there are fewer."""
        if token >> len(self.zeros):
            return -1
        begin, end = self._range(token, 0, self.size)
        at = begin + k
        if at >= end:
            return -1
        bits = len(self.zeros)
        for level in range(bits - 1, -1, -1):
            one = (token >> (bits - 1 - level)) & 1
            wanted = at - self.zeros[level] if one else at
            low, high = 0, self.size
            while low < high:  # the smallest prefix that holds wanted + 1 of this bit
                middle = (low + high) // 2
                ones = self._rank1(level, middle)
                if (ones if one else middle - ones) <= wanted:
                    low = middle + 1
                else:
                    high = middle
            at = low - 1
        return at

    def all(self) -> np.ndarray:
        """All ids, by undoing the planes from the lowest up."""
        bits = len(self.zeros)
        ids = np.zeros(self.size, np.uint32 if bits > 16 else np.uint16)
        for level in range(bits - 1, -1, -1):
            set_bits = np.unpackbits(self.planes[level], count=self.size).view(bool)
            before = np.empty_like(ids)
            before[~set_bits] = ids[: self.zeros[level]]
            before[set_bits] = ids[self.zeros[level] :] | ids.dtype.type(1 << (bits - 1 - level))
            ids = before
        return ids


def _known_characters(text: str) -> bool:
    """False if a character is newer than this Python's tables: only the tokenizer then knows its lower case."""
    import unicodedata

    return text.isascii() or all(unicodedata.category(c) != "Cn" for c in set(text))


def _normal(text: str, specials: Sequence[str]) -> str:
    if not any(s in text for s in specials):
        return lower_normal(text)
    import re

    parts = re.split("(" + "|".join(map(re.escape, specials)) + ")", text)
    return "".join(p if p in specials else lower_normal(p) for p in parts)


def tokens_of(texts: Sequence[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end and how many each has: words are split and looked up, new ones go to the tokenizer."""
    known = encoder(path, True)
    odd = {i: t for i, t in enumerate(texts) if not _known_characters(t)}
    normal = ["" if i in odd else _normal(t, known.specials) for i, t in enumerate(texts)]
    words = split_words(normal, WORD, known.specials)
    ids, sizes = spread(words.numbers, *flat_ids(known.encode(words.distinct)))
    ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(words.per_text)))]
    counts = np.diff(ends)
    if not odd:
        return ids, counts
    parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
    for i, text in odd.items():
        parts[i] = np.array(encoder(path, False).tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


def _write_chunks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, bits: int, chunk_tokens: int, key_type: pa.DataType):
    shard, chunk = TaskContext.get().partitionId(), 0
    keys: list = []
    counts: list[int] = []
    parts: list[np.ndarray] = []
    size = 0

    def row() -> pa.RecordBatch:
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"id {int(ids.max())} does not fit {bits} bits")
        matrix = WaveletMatrix.of(ids.astype(np.uint16) if bits <= 16 else ids, bits)
        columns = [
            pa.array([shard], pa.int32()),
            pa.array([chunk], pa.int32()),
            pa.array([keys], pa.list_(key_type)),
            pa.array([counts], pa.list_(pa.int64())),
            pa.array([len(ids)], pa.int64()),
            pa.array([matrix.zeros], pa.list_(pa.int64())),
            pa.array([matrix.planes.tobytes()], pa.binary()),
            pa.array([matrix.ones.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "chunk", "keys", "tokens", "size", "zeros", "planes", "ones"])

    for batch in batches:
        names = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for begin, stop in slices(texts, SLICE_CHARS):
            ids, sizes = tokens_of(texts[begin:stop], path)
            ends = np.cumsum(sizes)
            with_end = np.insert(ids, ends, end_id)
            # Chunks end with a document: cut where the running size first passes the limit.
            at = 0
            for i, total in enumerate((sizes + 1).tolist()):
                keys.append(names[begin + i])
                counts.append(total)
                size += total
                if size >= chunk_tokens:
                    upto = int(ends[i]) + i + 1
                    parts.append(with_end[at:upto])
                    yield row()
                    at, chunk, size = upto, chunk + 1, 0
                    keys, counts, parts = [], [], []
            parts.append(with_end[at:])
    if keys:
        yield row()


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    chunk_tokens: int = CHUNK_TOKENS,
    bits: int | None = None,
) -> None:
    """Encode every whole text, append `end_id` and write the ids in ascending key order to `path`.

    A NULL text is empty and has the end id alone; NULL keys come first; rows that share a key keep any order and may lie in
    several shards, so a key with very many rows is split. An empty table writes an empty one. Planes are as many as the largest id
    of the vocabulary needs; with fewer `bits`, an id that does not fit is an error. A chunk takes whole documents until it has `chunk_tokens` ids; a longer document is a chunk, and must be below two billion bytes.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    if bits is None:
        vocabulary = encoder(tokenizer, True).tokenizer.get_vocab(with_added_tokens=True)
        bits = max(end_id, *vocabulary.values()).bit_length()
    read = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("key").asc_nulls_first(), F.col("row").asc()]
    dealt = read.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    kind = read.schema["key"].dataType
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("chunk", T.IntegerType()),
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("tokens", T.ArrayType(T.LongType())),
            T.StructField("size", T.LongType()),
            T.StructField("zeros", T.ArrayType(T.LongType())),
            T.StructField("planes", T.BinaryType()),
            T.StructField("ones", T.BinaryType()),
        ]
    )
    task = partial(_write_chunks, path=tokenizer, end_id=end_id, bits=bits, chunk_tokens=chunk_tokens, key_type=to_arrow_type(kind))
    dealt.mapInArrow(task, schema).write.mode("error").option("compression", "zstd").parquet(path)


def chunk_starts(store: DataFrame) -> DataFrame:
    """(shard, chunk, first): ids before each chunk; shards are summed first, so no window holds all chunks of many shards."""
    sizes = store.select("shard", "chunk", "size")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("size").alias("total"))
    offsets = shards.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    placed = sizes.join(offsets, "shard").withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.select("shard", "chunk", (F.col("before") + F.col("within")).alias("first"))


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["size"], row["zeros"], row["planes"], row["ones"])


def _read_ids(batches: Iterator[pa.RecordBatch], key_type: pa.DataType, digests: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            ids = _matrix(row).all()
            counts = np.array(row["tokens"], np.int64)
            ends = np.cumsum(counts)
            n = len(counts)
            where = [pa.array(np.full(n, row["shard"], np.int32)), pa.array(np.full(n, row["chunk"], np.int32)), pa.array(row["keys"], key_type)]
            if digests:
                wide = ids.astype("<u4")
                last = pa.array([zlib.crc32(wide[b - c : b]) for b, c in zip(ends.tolist(), counts.tolist())], pa.int64())
            else:
                last = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.astype(np.int32)))
            columns = [*where, pa.array(ends - counts), pa.array(counts), last]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "chunk", "key", "offset", "n_tokens", "read"])


def read_tokens(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids) of every document from the files, or their checksum `ids_crc32` (ids as 4 little-endian bytes)."""
    from pyspark.sql.pandas.types import to_arrow_type

    store = spark.read.parquet(path)
    kind = store.schema["keys"].dataType.elementType
    last = T.LongType() if digests else T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("chunk", T.IntegerType()),
            T.StructField("key", kind),
            T.StructField("offset", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("read", last),
        ]
    )
    rows = store.mapInArrow(partial(_read_ids, key_type=to_arrow_type(kind), digests=digests), schema)
    placed = rows.join(chunk_starts(store), ["shard", "chunk"])
    return placed.select("key", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", F.col("read").alias("ids_crc32" if digests else "ids"))


def occurrences(spark: SparkSession, path: str, tokens: Sequence[int], positions: bool = False) -> DataFrame:
    """(token, n), or one row (token, position) per occurrence: counts by rank, places by select, from the planes alone."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = _matrix(row)
                for token in tokens:
                    n = matrix.rank(token, matrix.size)
                    found = [matrix.select(token, k) for k in range(n)] if positions else [n]
                    columns = [np.full(len(found), v) for v in (row["shard"], row["chunk"], token)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in [*columns, found]], ["shard", "chunk", "token", "n"])

    store = spark.read.parquet(path)
    found = store.mapInArrow(look, "shard bigint, chunk bigint, token bigint, n bigint")
    if not positions:
        return found.groupBy("token").agg(F.sum("n").alias("n"))
    return found.join(chunk_starts(store), ["shard", "chunk"]).select("token", (F.col("first") + F.col("n")).alias("position"))


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, token) of the distinct wanted positions, counted over the ids of all documents, by access to the planes alone. NULL
    positions and those beyond the last id are left out."""
    store = spark.read.parquet(path)
    chunks = chunk_starts(store).join(store.select("shard", "chunk", "size"), ["shard", "chunk"]).filter("size > 0")
    # Positions meet chunks by blocks of CHUNK_TOKENS positions, of which a chunk touches few however uneven chunks are.
    touched = F.explode(F.sequence(F.floor(F.col("first") / CHUNK_TOKENS), F.floor((F.col("first") + F.col("size") - 1) / CHUNK_TOKENS)))
    spans = chunks.withColumn("block", touched)
    wanted = positions.select(F.col(f"`{position}`").cast("bigint").alias("position")).dropna().distinct()
    met = wanted.withColumn("block", F.floor(F.col("position") / CHUNK_TOKENS)).join(spans, "block")
    inside = F.col("position") - F.col("first")
    found = met.filter((inside >= 0) & (inside < F.col("size"))).select("shard", "chunk", "first", inside.alias("at"))
    asked = found.groupBy("shard", "chunk", "first").agg(F.collect_list("at").alias("at"))  # at most the ids of one chunk
    rows = store.join(asked, ["shard", "chunk"]).select("first", "at", "size", "zeros", "planes", "ones")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = _matrix(row)
                tokens = [matrix.access(at) for at in row["at"]]
                yield pa.RecordBatch.from_arrays([pa.array([row["first"] + at for at in row["at"]], pa.int64()), pa.array(tokens, pa.int32())], ["position", "token"])

    return rows.mapInArrow(look, "position bigint, token int")
