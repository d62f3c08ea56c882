"""BPE encoding through a table of distinct words, and decoding through an id-to-piece table.

Texts are split into words in blocks of about 12 million characters. Every block numbers its different words and sends them,
sorted and compressed, to the words' hash buckets; there a word met in any number of blocks is encoded once, by the tokenizers library. Its
ids go back to the blocks, where every position holds the number of its word. What is shuffled is a block's different words and its
compressed positions, never a row per position.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.llm.memory import frugal, hand_back
from peerledger.llm.words import BYTE, encoder, flat_ids, slices, split_words, spread

BLOCK_CHARS = 12_000_000
SLICE_CHARS = 500_000
DECODED_IDS = 500_000
BLOCK_BITS = 24  # blocks of one task
LEAST_BUCKETS = 256  # of words; there are also at least eight for each shuffle partition, since a bucket is one task's


def compressed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def decompressed(data: bytes, size: int) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data, max_output_size=size + 1)


def packed(numbers: np.ndarray) -> bytes:
    """Non-negative integers below 2**32 as compressed byte planes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return compressed(planes.tobytes())


def unpacked(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(decompressed(data, 4 * count), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], specials: Sequence[str]) -> Iterator[tuple[int, dict[str, int], int, list, np.ndarray, np.ndarray]]:
    """(block, its words so far, slice, keys, words per text, word numbers) of one task's documents."""
    first = TaskContext.get().partitionId() << BLOCK_BITS
    block, known, size, part = first, {}, 0, 0
    for batch in batches:
        keys = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for begin, end in slices(texts, SLICE_CHARS):
            chars = sum(map(len, texts[begin:end]))
            if size and size + chars > BLOCK_CHARS:
                block, known, size, part = block + 1, {}, 0, 0
            words = split_words(texts[begin:end], BYTE, specials)
            local = np.fromiter((known.setdefault(w, len(known)) for w in words.distinct), np.int64, len(words.distinct))
            yield block, known, part, keys[begin:end], words.per_text, local[words.numbers]
            size, part = size + chars, part + 1


@frugal
def _words_of_blocks(batches: Iterator[pa.RecordBatch], specials: Sequence[str], buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per block and bucket: the block's numbers of the bucket's words, and the words, sorted and compressed."""

    def rows(block: int, known: dict[str, int]) -> pa.RecordBatch:
        words = [w.encode() for w in known]
        of = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        order = sorted(range(len(words)), key=lambda i: (of[i], words[i]))
        ends = np.searchsorted(of[order], np.arange(buckets + 1))
        columns: list[list] = [[], [], [], [], []]
        for bucket, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            if a < b:
                some = [words[i] for i in order[a:b]]
                sizes = np.fromiter(map(len, some), np.int64, b - a)
                row = (bucket, b - a, packed(np.array(order[a:b])), packed(sizes), compressed(b"".join(some)))
                for column, value in zip(columns, row):
                    column.append(value)
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))]
        return pa.RecordBatch.from_arrays([pa.array([block] * len(columns[0]), pa.int64()), *arrays], ["block", "bucket", "n", "numbers", "sizes", "words"])

    last = None
    for block, known, *_ in _blocks(batches, specials):
        if last is not None and last[0] != block:
            yield rows(*last)
        last = block, known
    if last is not None:
        yield rows(*last)


@frugal
def _positions_of_blocks(batches: Iterator[pa.RecordBatch], specials: Sequence[str], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for block, known, part, keys, per_text, numbers in _blocks(batches, specials):
        columns = [
            pa.array([block], pa.int64()),
            pa.array([part], pa.int32()),
            pa.array([keys], pa.list_(key_type)),
            pa.array([per_text.tolist()], pa.list_(pa.int64())),
            pa.array([packed(numbers)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["block", "part", "keys", "per_text", "numbers"])


@frugal
def _encode_words(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket, so the encoder meets all blocks' words of a bucket one after the other and remembers only them."""
    known, bucket = encoder(path, False), None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                bucket = row["bucket"]
                known.known.clear()
            sizes = unpacked(row["sizes"], row["n"]).astype(np.int64)
            blob, ends = decompressed(row["words"], int(sizes.sum())), np.cumsum(sizes).tolist()
            words = [blob[a:b].decode() for a, b in zip([0, *ends[:-1]], ends)]
            flat, counts = flat_ids(known.encode(words))
            values = ([row["block"]], [row["n"]], [row["numbers"]], [packed(counts)], [len(flat)], [packed(flat)])
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
            arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "n", "numbers", "counts", "total", "ids"])


def _join_back(positions: pa.Table, words: pa.Table, key_type: pa.DataType) -> pa.Table:
    """A block's positions with the ids of its words."""
    found = words.to_pylist()
    at = [unpacked(r["numbers"], r["n"]).astype(np.int64) for r in found]
    counts = np.zeros(sum(map(len, at)), np.int64)
    for numbers, row in zip(at, found):
        counts[numbers] = unpacked(row["counts"], row["n"])
    starts = np.cumsum(counts) - counts
    flat = np.zeros(int(counts.sum()), np.uint32)
    for numbers, row in zip(at, found):
        sizes = counts[numbers]
        place = np.repeat(starts[numbers] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        flat[place] = unpacked(row["ids"], row["total"])
    del found, at
    keys, ids = [], []
    for row in positions.sort_by("part").to_pylist():
        numbers = unpacked(row["numbers"], sum(row["per_text"])).astype(np.int64)
        if len(numbers) and numbers.max() >= len(counts):
            raise ValueError("a block and its words do not belong together")
        out, sizes = spread(numbers, flat, counts)
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(row["per_text"]))).astype(np.int64)]
        keys.append(pa.array(row["keys"], key_type))
        ids.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out.astype(np.int32))))
    hand_back()
    return pa.table([pa.chunked_array(keys, key_type), pa.chunked_array(ids, pa.list_(pa.int32()))], ["key", "ids"])


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(key, ids) of every document, as the tokenizers library encodes its whole text without added tokens.

    `tokenizer` is the file of a byte-level BPE that every executor can open. Special tokens' strings in a text are those tokens.
    A NULL or empty text has no ids; rows with equal or NULL keys stay rows of their own; other columns are not read. A block's
    words and positions, and a text however long, are handled in one task's memory.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    read = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = read.schema["key"].dataType
    arrow = to_arrow_type(kind)
    buckets = buckets or max(LEAST_BUCKETS, 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    specials = encoder(tokenizer, False).specials  # found here: only the tasks that encode words load the tokenizer
    words = "block bigint, bucket int, n int, numbers binary, sizes binary, words binary"
    by_bucket = read.mapInArrow(partial(_words_of_blocks, specials=specials, buckets=buckets), words).repartition("bucket")
    ids = "block bigint, n int, numbers binary, counts binary, total bigint, ids binary"
    encoded = by_bucket.sortWithinPartitions("bucket").mapInArrow(partial(_encode_words, path=tokenizer), ids)
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("per_text", T.ArrayType(T.LongType())),
            T.StructField("numbers", T.BinaryType()),
        ]
    )
    positions = read.mapInArrow(partial(_positions_of_blocks, specials=specials, key_type=arrow), schema)
    result = T.StructType([T.StructField("key", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    paired = positions.groupBy("block").cogroup(encoded.groupBy("block"))
    return paired.applyInArrow(partial(_join_back, key_type=arrow), result).withColumnRenamed("key", key)


@lru_cache(maxsize=4)
def pieces(path: str) -> list[bytes]:
    """The bytes of each id. Printable bytes stand for themselves in the vocabulary, the others for the code points after 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = encoder(path, False).tokenizer.get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        table[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return table


@frugal
def _decode(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    table = np.array(known.value, dtype=object)
    for whole in batches:
        ends = whole.column(1).offsets.to_numpy()
        sizes = np.diff(ends).tolist()
        for begin, stop in slices([range(n) for n in sizes], DECODED_IDS):
            batch = whole.slice(begin, stop - begin)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            at = [0, *np.cumsum(sizes[begin:stop]).tolist()]
            texts = [b"".join(table[flat[a:b]]).decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """Add `decoded`, the text of each row's ids, special tokens included, to (key, ids). The piece table is the vocabulary, which is
    broadcast. Broken UTF-8 becomes replacement characters; no ids give the empty text."""
    key = next(f for f in encoded.schema.fields if f.name != ids)
    schema = T.StructType([key, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    known = encoded.sparkSession.sparkContext.broadcast(pieces(tokenizer))
    return encoded.select(f"`{key.name}`", F.coalesce(F.col(ids), F.array().cast("array<int>")).alias(ids)).mapInArrow(
        partial(_decode, known=known), schema
    )
