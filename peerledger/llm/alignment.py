"""Aligning the tokens of two tokenizers by whitespace-token anchors.

1. Whole texts are tokenised by both. Each tokenizer's words (those of its own splitting rule) are encoded once as long as they stay
   in memory, and every word's token bytes are checked against its text.
2. Anchors are byte offsets at which tokens of both end and the next token of both starts with the space mark. They cut a document into
   windows, which are pairs of id tuples.
3. Equal windows are aligned once per block of documents: their groups, and the pairs of tokens whose bytes overlap. A document
   is the list of its windows' numbers.
4. What leaves a block for the corpus-wide counts is one row per distinct pair of ids. The counts come back to the block, where the
   windows' values are summed up for each document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, partial
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.llm.bpe import BLOCK_BITS, compressed, decompressed, packed, pieces, unpacked
from peerledger.llm.memory import frugal, hand_back
from peerledger.llm.spans import number_spans, ranges
from peerledger.llm.words import BYTE, slices, split_words, spread
from peerledger.session import stage, staging

BLOCK_CHARS = 8_000_000
SLICE_CHARS = 600_000
CACHED_WORDS = 150_000
SPACE_MARK = "▁"
NO_ID = b"\xff\xff\xff\xff"


def _sums(per_item: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(per_item)))[ends], prepend=0)


def _byte_lengths(words: Sequence[str], text: str) -> np.ndarray:
    """Of the words of a text, in UTF-8."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    if text.isascii():
        return lengths
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _sums(1 + (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF), np.cumsum(lengths))


def _numbered(known: dict, keys: list) -> tuple[np.ndarray, list[int]]:
    """The number of each of some distinct keys, and the places of the new ones, which get the next numbers."""
    found = list(map(known.get, keys))
    new = [i for i, number in enumerate(found) if number is None]
    if new:
        known.update(zip([keys[i] for i in new], range(len(known), len(known) + len(new))))
        found = list(map(known.get, keys))
    return np.array(found, np.int64), new


@dataclass
class Tokens:
    """Token ids of a list of texts end to end, how many each text has, and which texts hold a word that its tokens do not spell."""

    ids: np.ndarray
    per_text: np.ndarray
    misspelt: np.ndarray

    def of(self, texts: np.ndarray) -> Tokens:
        return Tokens(self.ids[np.repeat(texts, self.per_text)], self.per_text[texts], self.misspelt[texts])


def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids up to each end, 4 bytes each."""
    data, cuts = ids.tobytes(), (4 * ends).tolist()
    return [data[i:j] for i, j in zip([0, *cuts[:-1]], cuts)]


class Side:
    """A tokenizer that encodes words one by one, or many of those that `joins` names as one text, which it splits into them again.
    `spelt` has the bytes of each id."""

    def __init__(
        self, spelt: list[bytes], split: Callable, encode: Callable[[list[str]], Sequence[Sequence[int]]], joins: Callable[[str], bool] | None = None
    ):
        self.spelt, self.split, self.encode, self.joins = spelt, split, encode, joins
        self.sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
        self.spaced = np.fromiter((b.startswith(b" ") for b in spelt), bool, len(spelt))
        self.shown = np.array([str(i).encode() for i in range(len(spelt))])
        self.known: dict[str, bytes] = {}  # ids as 4 bytes each
        self.wrong: set[str] = set()  # of the known words

    def spells(self, ids: Sequence[int], text: str) -> bool:
        return b"".join([self.spelt[i] for i in ids]) == text.encode()

    def _remember(self, words: list[str]) -> list[bytes]:
        """Encode and keep words; their ids."""
        joins = list(map(self.joins, words)) if self.joins is not None else [False] * len(words)
        joined = self._joined(list(compress(words, joins))) if any(joins) else []
        if joined is None:
            joins, joined = [False] * len(words), []
        single = self._single([w for w, joined_one in zip(words, joins) if not joined_one])
        parts = {True: iter(joined), False: iter(single)}
        ids = [next(parts[joined_one]) for joined_one in joins]
        self.known.update(zip(words, ids))
        return ids

    def _single(self, words: list[str]) -> list[bytes]:
        new = self.encode(words)
        per_word = np.fromiter(map(len, new), np.int64, len(new))
        ends = np.cumsum(per_word)
        flat = np.fromiter(chain.from_iterable(new), np.uint32, int(per_word.sum()))
        text = "".join(words)
        if not (np.array_equal(_sums(self.sizes[flat], ends), _byte_lengths(words, text)) and self.spells(flat.tolist(), text)):
            self.wrong.update(w for w, ids in zip(words, new) if not self.spells(ids, w))
        return _cut(flat, ends)

    def _joined(self, words: list[str]) -> list[bytes] | None:
        """Encode words as one text, several times faster than one by one. None if the tokens do not spell it word by word."""
        text = "".join(words)
        ids = np.array(self.encode([text])[0], np.uint32)
        ends = np.cumsum(self.sizes[ids])
        stops = np.cumsum(_byte_lengths(words, text))
        at = np.searchsorted(ends, stops)
        if not len(ends) or ends[-1] != stops[-1] or not np.array_equal(ends[at], stops) or not self.spells(ids.tolist(), text):
            return None
        return _cut(ids, at + 1)

    def tokens(self, texts: Sequence[str]) -> Tokens:
        words, numbers, per_text = self.split(texts)
        found = list(map(self.known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            if len(self.known) + len(missing) > CACHED_WORDS:
                self.known = {w: ids for w, ids in zip(words, found) if ids is not None}
                self.wrong &= self.known.keys()
            for i, ids in zip(missing, self._remember([words[i] for i in missing])):
                found[i] = ids
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, sizes = spread(numbers, np.frombuffer(b"".join(found), "<u4"), counts)
        owner = np.repeat(np.arange(len(texts)), per_text)
        misspelt = np.zeros(len(texts), bool)
        if self.wrong:
            wrong = np.fromiter(map(self.wrong.__contains__, words), bool, len(words))
            misspelt[owner[wrong[numbers]]] = True
        return Tokens(ids, np.bincount(owner, sizes, len(texts)).astype(np.int64), misspelt)

    def whole(self, text: str) -> Tokens:
        """One text encoded in one piece."""
        ids = self.encode([text])[0]
        return Tokens(np.array(ids, np.uint32), np.array([len(ids)]), np.array([not self.spells(ids, text)]))


def _split_bytes(texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    words = split_words(texts, BYTE)
    return words.distinct, words.numbers, words.per_text


def _split_pieces(texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words are spaces and what follows up to the next space. Texts start with a space."""
    joined = "".join(texts)
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = chars == 32
    starts[1:] &= chars[:-1] != 32
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts[np.cumsum(sizes) - sizes] = True
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], len(chars))
    numbers, first = number_spans([(chars, begin, end)])
    words = [joined[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
    return words, numbers, np.bincount(np.searchsorted(np.cumsum(sizes), begin, side="right"), minlength=len(texts))


def _split_nothing(texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    known: dict[str, int] = {}
    numbers = np.fromiter((known.setdefault(t, len(known)) for t in texts), np.int64, len(texts))
    return list(known), numbers, np.ones(len(texts), np.int64)


@lru_cache(maxsize=2)
def byte_side(path: str) -> Side:
    """A byte-level BPE file of the tokenizers library, which encodes the space before a text as given."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    return Side(pieces(path), _split_bytes, encode, lambda word: word[0] == " " and word[1:].isalpha())


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    """A sentencepiece model, which adds the space before a text by itself. Where a piece goes on after a space mark that is not among
    its first characters, words cannot be encoded alone and texts are encoded whole."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    spelt = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(names)]
    space = [model.piece_to_id(SPACE_MARK)]

    def encode(words: list[str]) -> list[list[int]]:
        found = model.encode([w[1:] for w in words], num_threads=1) if words else []
        return [ids if w != " " else space for w, ids in zip(words, found)]

    alone = all(SPACE_MARK not in p.lstrip(SPACE_MARK) for p in names)
    return Side(spelt, _split_pieces if alone else _split_nothing, encode)


def _groups_shown(a: Side, b: Side, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, last: np.ndarray) -> list[str]:
    """Windows as text, from the ids of their groups end to end, how many each group has, and which groups end a window. Ids are written
    as rows of digits, groups of a before those of b, and what is not filled of the rows is left out."""
    ends = np.cumsum(n_a + n_b)
    place_a, place_b = ranges(ends - n_b - n_a, n_a), ranges(ends - n_b, n_b)
    width = max(a.shown.itemsize, b.shown.itemsize)
    text = np.zeros((len(ids_a) + len(ids_b), width + 1), np.uint8)
    for side, ids, places in ((a, ids_a, place_a), (b, ids_b, place_b)):
        text[places, :width] = side.shown[ids].astype(f"S{width}").view(np.uint8).reshape(-1, width)
    text[:, width] = ord(",")
    text[ends - n_b - 1, width] = ord("|")
    text[ends - 1, width] = np.where(last, ord("\n"), ord(";"))
    return text[text > 0].tobytes().decode()[:-1].split("\n")


@dataclass
class Block:
    """The distinct windows of some documents."""

    name: int
    numbers: dict[bytes, int] = field(default_factory=dict)  # by ids of both, 4 bytes each, and a mark between them
    shown: list[str] = field(default_factory=list)  # groups of each window, as text
    n_groups: list[int] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)  # numbers of the pairs that new windows of a slice link, end to end
    n_links: list[int] = field(default_factory=list)
    pairs: dict[int, int] = field(default_factory=dict)  # a * 2**32 + b
    seen: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # occurrences of each window
    chars: int = 0
    parts: int = 0

    def windows(self, a: Side, b: Side, left: Tokens, right: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, per text) of the windows of texts that both token lists spell."""
        if not len(left.per_text):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end_a, end_b = np.cumsum(a.sizes[left.ids]), np.cumsum(b.sizes[right.ids])
        mark = np.zeros(int(end_a[-1]) + 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        ends = np.flatnonzero(mark)
        kind = mark[ends]
        done_a, done_b = np.cumsum(kind & 1, dtype=np.int64), np.cumsum(kind >> 1, dtype=np.int64)
        anchor = kind == 3
        anchor[:-1] &= a.spaced[left.ids[np.minimum(done_a[:-1], len(left.ids) - 1)]]
        anchor[:-1] &= b.spaced[right.ids[np.minimum(done_b[:-1], len(right.ids) - 1)]]
        stop = np.flatnonzero(anchor) + 1  # segments: a segment ends where a token of either ends, and links the two it lies in
        start = np.concatenate(([0], stop[:-1]))
        to_a, to_b = done_a[stop - 1], done_b[stop - 1]
        from_a, from_b = np.concatenate(([0], to_a[:-1])), np.concatenate(([0], to_b[:-1]))
        local, first = number_spans([(left.ids, from_a, to_a), (right.ids, from_b, to_b)])

        data_a, data_b = left.ids.tobytes(), right.ids.tobytes()
        spans = zip(*((4 * at[first]).tolist() for at in (from_a, to_a, from_b, to_b)))
        here, fresh = _numbered(self.numbers, [data_a[a0:a1] + NO_ID + data_b[b0:b1] for a0, a1, b0, b1 in spans])
        if fresh:
            new = first[fresh]
            sizes = stop[new] - start[new]
            at = ranges(start[new], sizes)
            token_a, token_b = (done_a - (kind & 1))[at], (done_b - (kind >> 1))[at]
            codes = left.ids[token_a].astype(np.int64) << 32 | right.ids[token_b].astype(np.int64)
            distinct, back = np.unique(codes, return_inverse=True)
            self.links.append(_numbered(self.pairs, distinct.tolist())[0][back])
            self.n_links += sizes.tolist()
            shared = np.flatnonzero(kind[at] == 3)  # ends of groups; the last one of a window is its end
            per_window = np.diff(np.searchsorted(shared, np.cumsum(sizes)), prepend=0)
            last = np.cumsum(per_window) - 1
            stop_a, stop_b = done_a[at[shared]], done_b[at[shared]]
            start_a, start_b = (np.concatenate(([0], stops[:-1])) for stops in (stop_a, stop_b))
            start_a[last - per_window + 1], start_b[last - per_window + 1] = from_a[new], from_b[new]
            size_a, size_b = stop_a - start_a, stop_b - start_b
            ends_window = np.zeros(len(shared), bool)
            ends_window[last] = True
            ids_a, ids_b = left.ids[ranges(start_a, size_a)], right.ids[ranges(start_b, size_b)]
            self.shown += _groups_shown(a, b, ids_a, size_a, ids_b, size_b, ends_window)
            self.n_groups += per_window.tolist()
        numbers = here[local]
        counted = np.bincount(numbers, minlength=len(self.shown))
        counted[: len(self.seen)] += self.seen
        self.seen = counted
        text_ends = np.cumsum(np.add.reduceat(a.sizes[left.ids], np.cumsum(left.per_text) - left.per_text))
        upto = np.searchsorted(ends[stop - 1], text_ends, side="right")
        return numbers, np.diff(upto, prepend=0)


def _part(block: Block, a: Side, b: Side, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of a, tokens of b, windows) per text, and the windows' numbers end to end."""
    n_a, n_b, n_windows = np.zeros((3, len(texts)), np.int64)
    some = np.flatnonzero(np.fromiter(map(len, texts), np.int64, len(texts)))
    spaced = [" " + texts[i] for i in some.tolist()]
    left, right = (a.tokens(spaced), b.tokens(spaced)) if spaced else (None, None)
    if left is None:
        return n_a, n_b, n_windows, np.zeros(0, np.int64)
    odd = left.misspelt | right.misspelt
    plain = some[~odd]
    left, right = left.of(~odd), right.of(~odd)
    numbers, n_windows[plain] = block.windows(a, b, left, right)
    n_a[plain], n_b[plain] = left.per_text, right.per_text
    if not odd.any():
        return n_a, n_b, n_windows, numbers
    at = np.concatenate(([0], np.cumsum(n_windows)))
    rows = [numbers[at[i] : at[i + 1]] for i in range(len(texts))]
    for i in some[odd].tolist():  # a word that its tokens do not spell: the text counts only if it is spelt when encoded whole
        left, right = a.whole(" " + texts[i]), b.whole(" " + texts[i])
        if not (left.misspelt[0] or right.misspelt[0]):
            rows[i], (n_windows[i],) = block.windows(a, b, left, right)
            n_a[i], n_b[i] = left.per_text[0], right.per_text[0]
    return n_a, n_b, n_windows, np.concatenate(rows)


def _fields(key: pa.DataType) -> dict[str, pa.DataType]:
    """A block has a row per part of its documents, and a last one with its windows and pairs, whose part is NULL."""
    longs = pa.list_(pa.int64())
    parts = {"block": pa.int64(), "part": pa.int32(), "keys": pa.list_(key), "n_a": longs, "n_b": longs, "n_windows": longs, "numbers": pa.binary()}
    windows = {"windows": pa.int64(), "shown": pa.binary(), "n_shown": pa.int64(), "n_groups": pa.binary(), "n_links": pa.binary(), "links": pa.binary()}
    return parts | windows | {"a": pa.list_(pa.int32()), "b": pa.list_(pa.int32()), "n": longs}


def _row(values: dict, key: pa.DataType) -> pa.RecordBatch:
    fields = _fields(key)
    return pa.RecordBatch.from_arrays([pa.array([values.get(name)], kind) for name, kind in fields.items()], list(fields))


def _block_row(block: Block, key: pa.DataType) -> pa.RecordBatch:
    links = np.concatenate([np.zeros(0, np.int64), *block.links])
    n_links = np.array(block.n_links, np.int64)
    seen = np.bincount(links, np.repeat(block.seen, n_links), len(block.pairs)).astype(np.int64)  # exact below 2**53
    codes = np.fromiter(block.pairs, np.int64, len(block.pairs))
    shown = "\n".join(block.shown).encode()
    values = {
        "block": block.name,
        "windows": len(block.shown),
        "shown": compressed(shown),
        "n_shown": len(shown),
        "n_groups": packed(np.array(block.n_groups, np.int64)),
        "n_links": packed(n_links),
        "links": packed(links),
        "a": (codes >> 32).tolist(),
        "b": (codes & 0xFFFFFFFF).tolist(),
        "n": seen.tolist(),
    }
    return _row(values, key)


@frugal
def _blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    a, b = byte_side(path_a), piece_side(path_b)
    block = Block(TaskContext.get().partitionId() << BLOCK_BITS)
    for batch in batches:
        keys = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for begin, end in slices(texts, SLICE_CHARS):
            chars = sum(map(len, texts[begin:end]))
            if block.chars and block.chars + chars > BLOCK_CHARS:
                yield _block_row(block, key)
                block = Block(block.name + 1)
            n_a, n_b, n_windows, numbers = _part(block, a, b, texts[begin:end])
            counts = {"n_a": n_a.tolist(), "n_b": n_b.tolist(), "n_windows": n_windows.tolist()}
            yield _row({"block": block.name, "part": block.parts, "keys": keys[begin:end], "numbers": packed(numbers)} | counts, key)
            block.chars, block.parts = block.chars + chars + 1, block.parts + 1
    if block.parts:
        yield _block_row(block, key)


def _documents(rows: pa.Table, values: pa.Table, key: pa.DataType) -> pa.Table:
    """The documents of a block, from its rows and the corpus-wide (number, count, best) of its pairs."""
    found = rows.to_pylist()
    block = next(r for r in found if r["part"] is None)
    count, best = np.zeros((2, len(block["a"])), np.int64)
    number = values.column("number").to_numpy()
    count[number] = values.column("count").to_numpy()
    best[number] = values.column("best").to_numpy(zero_copy_only=False)
    windows = block["windows"]
    n_groups, n_links = (unpacked(block[c], windows).astype(np.int64) for c in ("n_groups", "n_links"))
    links = unpacked(block["links"], int(n_links.sum())).astype(np.int64)
    best, count = (_sums(v[links], np.cumsum(n_links)) for v in (best, count))
    shown = decompressed(block["shown"], block["n_shown"]).decode().split("\n")
    columns: list[list[pa.Array]] = [[] for _ in range(8)]
    for row in sorted((r for r in found if r["part"] is not None), key=lambda r: r["part"]):
        ends = np.cumsum(row["n_windows"])
        numbers = unpacked(row["numbers"], int(ends[-1])).astype(np.int64)
        sums = [pa.array(_sums(v[numbers], ends)) for v in (n_groups, n_links, best, count)]
        listed, at = numbers.tolist(), [0, *ends.tolist()]
        groups = [";".join([shown[k] for k in listed[i:j]]) for i, j in zip(at[:-1], at[1:])]
        values = [pa.array(row["keys"], key), pa.array(row["n_a"], pa.int64()), pa.array(row["n_b"], pa.int64()), *sums, pa.array(groups, pa.large_string())]
        for column, value in zip(columns, values):
            column.append(value)
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    chunked = [pa.chunked_array(c) for c in columns]
    hand_back()
    return pa.table([*chunked[:-1], chunked[-1].cast(pa.string())], names)


def align(docs: DataFrame, byte_bpe: str, piece_model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every document.

    Tokens a are those of a space and the text by the byte-level BPE file `byte_bpe`, tokens b those of the text by the sentencepiece
    model `piece_model`, both without special tokens, whose strings in a text are plain text; executors can open both files. Groups
    end where tokens of both end: `groups` lists the ids as `a1,a2|b1;a3|b2,b3`. A link is a pair of tokens whose bytes overlap; a pair of
    ids counts as often as links of the whole corpus hold it. `n_best` are the links whose pair counts highest for its b id, `count_sum`
    sums the links' counts. A text that is NULL or empty, or that the bytes of either's tokens do not spell, has no tokens: zeros and ''.
    Rows with equal or NULL keys stay rows of their own; other columns are not read. A block of documents, or one longer text, is
    handled in one task's memory.
    """
    from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

    read = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = read.schema["key"].dataType
    arrow = to_arrow_type(kind)
    schema = T.StructType([T.StructField(name, from_arrow_type(t)) for name, t in _fields(arrow).items()])
    with staging(docs.sparkSession) as scope:
        blocks = stage(read.mapInArrow(partial(_blocks, path_a=byte_bpe, path_b=piece_model, key=arrow), schema), "token-windows")
        pairs = blocks.filter("part is null").select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("number", "pair"))
        pairs = pairs.select("block", "number", "pair.*")
        counts = stage(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
        highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
        judged = counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
        judged = stage(judged, "pair-values")
        scope.keep(blocks, judged)
    values = pairs.join(judged, ["a", "b"]).select(F.col("block").alias("of"), "number", "count", "best")
    longs = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    result = T.StructType([T.StructField("key", kind), *longs, T.StructField("groups", T.StringType())])
    paired = blocks.groupBy("block").cogroup(values.groupBy("of"))
    return paired.applyInArrow(lambda rows, found: _documents(rows, found, arrow), result).withColumnRenamed("key", key)
