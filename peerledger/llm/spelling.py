"""Spelling variants: words that differ by one inserted, deleted or replaced letter, by dense prefix-suffix tiling.

1. Texts are cut into runs of letters; tasks count them, so that what is shuffled is a task's distinct words.
2. One edit leaves the first half or the last half of a word as it is. Every word goes to the cells of its halves, for its own length and
   the next, which is all that it can share with a near word. Every cell is cut into blocks, and block pairs become tiles.
3. A tile is a padded matrix of code points, left-aligned and right-aligned. All its rows are compared at once, one diagonal of the
   tile after the other: common prefix plus common suffix reaching the longer length less one is a single edit.
4. Each pair is found in one tile only: in cells of the longer word's length, and by its last half only where the first halves differ.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerledger.llm.memory import frugal
from peerledger.llm.spans import number_spans
from peerledger.llm.words import slices
from peerledger.session import stage, staging

SLICE_CHARS = 500_000
HELD_WORDS = 300_000  # distinct words that a task counts before it hands them on
BLOCK = 1024  # rows of a tile's side, fewer for long words
TILE_CELLS = 2_000_000  # code points of a tile's side
#: A letter is in these ranges of code points; of them, A to Z are lower-cased.
LETTERS = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF))
CRC_POLYNOMIAL = 0xEDB88320


def _letter_table() -> np.ndarray:
    """The lower-cased letter of each code point below 256, 0 where there is none."""
    table = np.zeros(257, np.uint8)  # the last entry stands for all other code points
    for low, high in LETTERS:
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] += 32
    return table


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(CRC_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


LETTER, CRC = _letter_table(), _crc_table()


def _step(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return CRC[(state ^ byte) & 0xFF] ^ (state >> np.uint32(8))


def keyed_crc(prefixes: list[bytes], owner: np.ndarray, letters: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each run's UTF-8 after its owner's prefix."""
    states = np.fromiter((zlib.crc32(p) ^ 0xFFFFFFFF for p in prefixes), np.uint32, len(prefixes))[owner]
    order = np.argsort(begin - end, kind="stable")  # long runs first, so that those still running are a prefix
    state, at = states[order], begin[order]
    sizes = (end - begin)[order]
    running = len(order)
    for place in range(int(sizes[0]) if len(sizes) else 0):
        running = int(np.searchsorted(-sizes, -place, side="left"))
        letter = letters[at[:running] + place].astype(np.uint32)
        now = state[:running]
        wide = letter >= 0x80
        if wide.any():
            now = np.where(wide, _step(now, 0xC3), now)
            letter = np.where(wide, letter - 0x40, letter)
        state[:running] = _step(now, letter)
    answer = np.empty(len(order), np.uint32)
    answer[order] = state ^ np.uint32(0xFFFFFFFF)
    return answer


@frugal
def _count_words(batches: Iterator[pa.RecordBatch], least: int, deletion: int | None) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        keys = ["" if k is None else str(k) for k in batch.column(0).to_pylist()]
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for first, last in slices(texts, SLICE_CHARS):
            chars = np.frombuffer("\n".join(texts[first:last]).encode("utf-32-le"), np.uint32)
            letters = LETTER[np.minimum(chars, 256)]
            inside = np.concatenate(([False], letters > 0, [False]))
            edge = np.flatnonzero(inside[1:] != inside[:-1])
            begin, end = edge[::2], edge[1::2]
            long = end - begin >= least
            begin, end = begin[long], end[long]
            if not len(begin):
                continue
            cut = np.zeros(len(begin), bool)
            if deletion is not None:
                ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts[first:last]), np.int64, last - first))
                owner = np.searchsorted(ends, begin, side="right")
                crc = keyed_crc([f"{k}:".encode() for k in keys[first:last]], owner, letters, begin, end)
                cut = crc % deletion == 0
                for a, b, h in zip(begin[cut].tolist(), end[cut].tolist(), crc[cut].tolist()):
                    if b - a > least:
                        word, gone = letters[a:b].tobytes().decode("latin-1"), h % (b - a)
                        word = word[:gone] + word[gone + 1 :]
                        held[word] = held.get(word, 0) + 1
            begin, end = begin[~cut], end[~cut]
            numbers, where = number_spans([(letters, begin, end)])
            for a, b, n in zip(begin[where].tolist(), end[where].tolist(), np.bincount(numbers, minlength=len(where)).tolist()):
                word = letters[a:b].tobytes().decode("latin-1")
                held[word] = held.get(word, 0) + n
            if len(held) > HELD_WORDS:
                yield out()
    yield out()


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5, deletion: int | None = None
) -> DataFrame:
    """(word, n): runs of letters, A to Z lower-cased, of at least `least_length` code points and `least_count` occurrences.

    With `deletion`, a run loses one letter where the crc32 of `<key>:<run>` is a multiple of it, as a planted typing error; the key of
    a NULL is the empty text. NULL and empty texts have no words; repeated rows count each.
    """
    read = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    counted = read.mapInArrow(partial(_count_words, least=least_length, deletion=deletion), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _aligned(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Padded code points of the words, and of the words read backwards. 0 pads."""
    joined = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) + np.uint32(1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ahead, back = (np.zeros((len(words), int(sizes.max()) + 1), np.uint32) for _ in range(2))
    ahead[row, place] = joined
    back[row, np.repeat(sizes, sizes) - 1 - place] = joined
    return ahead, back


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first columns are equal, row by row. The last column is padding."""
    differs = a != b
    differs[:, -1] = True
    return differs.argmax(axis=1)


def near_in_tiles(words: list[str], tiles: np.ndarray, longer: np.ndarray, by_tail: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of single edits among the rows of each tile; a tile's rows are neighbours. The diagonals of all tiles are compared
    together: rows d apart, for d = 1, 2, ... until no tile is that large. In a tile of two blocks, pairs of one side belong elsewhere."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ahead, back = _aligned(words)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at, apart = np.arange(len(words) - 1), 1
    while True:
        at = at[at + apart < len(words)]
        at = at[tiles[at] == tiles[at + apart]]
        if not len(at):
            break
        other = at + apart
        length = np.maximum(sizes[at], sizes[other])
        able = (length == longer[at]) & ((side[at] < 0) | (side[at] != side[other]))
        i, j, most = at[able], other[able], length[able]
        head = _common(ahead[i], ahead[j])
        near = head + _common(back[i], back[j]) >= most - 1
        near &= ~(by_tail[i] & (head >= most // 2))
        found.append((i[near], j[near]))
        apart += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(f[0] for f in found)]), np.concatenate([none, *(f[1] for f in found)])


@frugal
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows that come sorted by length and cell. A cell may run on into the next batches."""
    rest: list[tuple] = []

    def pairs(rows: list[tuple]) -> pa.RecordBatch:
        longer, cell, tail, words, n, side = zip(*rows)
        numbers = np.cumsum(np.array([True, *(a != b for a, b in zip(zip(longer, cell), zip(longer[1:], cell[1:])))]))
        i, j = near_in_tiles(list(words), numbers, np.array(longer), np.array(tail), np.array(side))
        i, j = i.tolist(), j.tolist()
        columns = [[words[k] for k in i], [n[k] for k in i], [words[k] for k in j], [n[k] for k in j]]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "n_a", "b", "n_b"])

    for batch in batches:
        rows = rest + list(zip(*(c.to_pylist() for c in batch.columns)))
        start = done = 0
        for k in range(1, len(rows)):
            if rows[k][:2] != rows[k - 1][:2]:
                done = k
                if (done - start) * (rows[start][0] + 1) > TILE_CELLS:
                    yield pairs(rows[start:done])
                    start = done
        if start < done:
            yield pairs(rows[start:done])
        rest = rows[done:]
    if rest:
        yield pairs(rest)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of different words (word, n) that one edit turns into each other, once."""
    size, word = F.char_length("word"), F.col("word")

    def cell(longer, by_tail: bool):
        half = F.floor(longer / 2).cast("int")
        part = F.substring(word, size - (longer - half) + 1, longer - half) if by_tail else F.substring(word, F.lit(1), half)
        return F.struct(longer.alias("longer"), F.concat(F.lit("t" if by_tail else "h"), part).alias("cell"), F.lit(by_tail).alias("tail"))

    cells = F.array(*[cell(longer, by_tail) for longer in (size, size + 1) for by_tail in (False, True)])
    placed = stage(words.select("word", "n", F.explode(cells).alias("at")).select("at.*", "word", "n"), "word-cells")
    loads = placed.groupBy("longer", "cell").count().filter("count > 1")
    side = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(TILE_CELLS) / F.col("longer"))))
    loads = stage(loads.select("longer", "cell", F.ceil(F.col("count") / side).cast("int").alias("blocks")), "cell-blocks")
    dealt = placed.join(loads, ["longer", "cell"]).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", partner)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tile = F.concat_ws(" ", "cell", low, high)
    inside = F.when(low == high, F.lit(-1)).otherwise(F.col("block")).alias("side")
    tiles = dealt.select("longer", tile.alias("cell"), "tail", "word", "n", inside)
    ordered = tiles.repartition("longer", "cell").sortWithinPartitions("longer", "cell")
    return ordered.mapInArrow(_compare, "a string, n_a bigint, b string, n_b bigint")


def spelling_forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each (word, n).

    `form` is the near word with the largest n, the first in code-point order of several, if its n is at least `ratio` times the
    word's; else NULL. `root` is where following the forms ends, the word itself if it has none. n_near counts the near words.
    """
    with staging(words.sparkSession) as scope:
        words = stage(words, "words")
        pairs = stage(near_pairs(words), "near-words")
        both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m"))
        both = both.union(pairs.select("b", "a", "n_a"))
        best = F.min(F.struct((-F.col("m")).alias("less"), F.col("near").alias("near"))).alias("best")
        nearest = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
        joined = words.join(nearest, "word", "left")
        able = -F.col("best.less") >= ratio * F.col("n")
        form, form_n = F.when(able, F.col("best.near")), F.when(able, -F.col("best.less"))
        forms = joined.select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), form_n.alias("form_n"))
        forms = stage(forms, "word-forms")

        # Following forms doubles its reach each round; each step multiplies n by the ratio, so a few rounds are enough.
        reach = stage(forms.filter("form is not null").select("word", F.col("form").alias("root")), "form-steps")
        while not reach.join(reach.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
            step = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
            reach = stage(reach.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "form-steps")
        scope.keep(forms, reach)
    rooted = forms.join(reach, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
