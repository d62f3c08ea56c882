"""Splitting batches of texts into the words that a BPE tokenizer encodes one by one, and encoding every different word once.

Both splitting rules are published patterns: `BYTE` keeps white space (a word takes one space before it), `WORD` drops it and
takes digits one by one. The split works on arrays of code points: runs of one class are words, and the contractions and spaces
move some of the borders. Work and memory are linear in the characters of a batch.
"""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np

BYTE, WORD = "byte", "word"
OTHER, LETTER, DIGIT, SPACE = 0, 1, 2, 3
#: The letters after an apostrophe that make a word of their own.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
ODD = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 800_000
WORD_END = "</w>"


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    import regex

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            table[ord(every[found.start()]) : ord(every[found.end() - 1]) + 1] = kind
    return table


@dataclass
class Words:
    """The words of a batch: `distinct` in order of first use, the number of each word in it, and the words of each text."""

    distinct: list[str]
    special: np.ndarray  # of each distinct word: is it a special token
    numbers: np.ndarray
    per_text: np.ndarray


def _segments(texts: Sequence[str], specials: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut around special tokens; which segments are special; the text of each segment."""
    if not any(s in t for s in specials for t in texts):
        return list(texts), np.zeros(len(texts), bool), np.arange(len(texts))
    import re

    cut = re.compile("(" + "|".join(map(re.escape, specials)) + ")")
    parts = [[p for p in cut.split(t) if p] or [""] for t in texts]
    flat = list(chain.from_iterable(parts))
    known = set(specials)
    return flat, np.array([p in known for p in flat]), np.repeat(np.arange(len(texts)), [len(p) for p in parts])


def _marks(chars: np.ndarray, edges: np.ndarray, style: str) -> tuple[np.ndarray, np.ndarray]:
    """Where words start, and where a word or the gap after it starts."""
    kinds = code_point_classes()[chars]
    n = len(chars)
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    edge[0] = edge[n] = True
    runs = np.empty(n + 1, bool)
    runs[0] = runs[n] = True
    runs[1:n] = kinds[1:] != kinds[:-1]
    runs |= edge
    starts = runs[:n].copy()
    begin = np.flatnonzero(runs)
    begin, end = begin[:-1], begin[1:]
    if style == BYTE:
        followed = end[(kinds[begin] == SPACE) & ~edge[end]]
        starts[followed - 1] = True
        starts[followed[chars[followed - 1] == 32]] = False
    else:
        starts[kinds == DIGIT] = True
    quote = (chars[begin] == ord("'")) & (end == begin + 1) & starts[begin] & ~edge[end]
    at = np.flatnonzero(quote)
    if len(at):
        at = at[kinds[end[at]] == LETTER]
        first = end[at]
        stop = end[at + 1]
        letter = chars[first]
        taken = np.isin(letter, [ord(c) for c in SHORT_ENDINGS]).astype(np.int64)
        second = chars[np.minimum(first + 1, n - 1)]
        for a, b in LONG_ENDINGS:
            taken[(letter == ord(a)) & (second == ord(b)) & (stop - first > 1)] = 2
        first, stop, taken = first[taken > 0], stop[taken > 0], taken[taken > 0]
        starts[first] = False
        inner = first + taken < stop
        starts[(first + taken)[inner]] = True
    if style == WORD:
        starts &= kinds != SPACE
        gaps = runs[:n] & (kinds == SPACE)
        return starts, starts | gaps
    return starts, starts


def split_words(texts: Sequence[str], style: str, specials: Sequence[str] = ()) -> Words:
    import pandas as pd

    segments, is_special, text_of = _segments(texts, specials)
    joined = "".join(segments)
    if not joined:
        return Words([], np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(len(texts), np.int64))
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    ends_of = np.cumsum(lengths)
    starts, marks = _marks(chars, np.concatenate(([0], ends_of)), style)
    for k in np.flatnonzero(is_special):
        a, b = ends_of[k] - lengths[k], ends_of[k]
        starts[a:b] = marks[a:b] = False
        starts[a] = marks[a] = True
    begin = np.flatnonzero(starts)
    borders = np.append(np.flatnonzero(marks), len(chars))
    end = borders[np.searchsorted(borders, begin, side="right")] if style == WORD else borders[1:]
    # A word's key is its part of a running polynomial, shifted to the word's start; all modulo 2**64.
    powers = np.full(len(chars) + 1, ODD, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    running = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=running[1:])
    # Shifting up to a common exponent avoids inverse powers.
    keys = (running[end] - running[begin]) * powers[len(chars) - begin]
    del powers, running
    codes, _ = pd.factorize(keys)
    first = np.empty(int(codes.max()) + 1 if len(codes) else 0, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    if not _same_words(chars, begin, end, first[codes]):
        return _split_slowly(joined, begin, end, text_of, ends_of, is_special, len(texts))
    segment = np.searchsorted(ends_of, begin, side="right")
    distinct = [joined[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
    per_text = np.bincount(text_of[segment], minlength=len(texts))
    return Words(distinct, is_special[segment[first]], codes.astype(np.int64), per_text)


def _same_words(chars: np.ndarray, begin: np.ndarray, end: np.ndarray, model: np.ndarray) -> bool:
    """Is every word equal, character by character, to the first word of the same key?"""
    lengths = end - begin
    if not np.array_equal(lengths, lengths[model]):
        return False
    moved = np.flatnonzero(begin != begin[model])
    sizes = lengths[moved]
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.array_equal(chars[at + np.repeat(begin[moved], sizes)], chars[at + np.repeat(begin[model[moved]], sizes)])


def _split_slowly(joined, begin, end, text_of, ends_of, is_special, texts: int) -> Words:
    """Should two words ever share a key: number them by themselves."""
    known: dict[tuple[str, bool], int] = {}
    segment = np.searchsorted(ends_of, begin, side="right")
    flags = is_special[segment]
    numbers = [known.setdefault((joined[a:b], bool(s)), len(known)) for a, b, s in zip(begin.tolist(), end.tolist(), flags)]
    per_text = np.bincount(text_of[segment], minlength=texts)
    return Words([w for w, _ in known], np.array([s for _, s in known], bool), np.array(numbers, np.int64), per_text)


def lower_normal(text: str) -> str:
    """The normal form and lower case that the WORD vocabulary expects; letter by letter, so without a final sigma."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class WordEncoder:
    """Encodes words with a tokenizer file, each different word once as long as it stays among the CACHED_WORDS remembered ones."""

    def __init__(self, path: str, normalized: bool):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        if normalized:  # the caller has brought texts to the normal form
            self.tokenizer.normalizer = normalizers.Sequence([])
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # ids as 4 bytes each
        self.ends = None  # of each id: does it end a word
        if normalized:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True

    def encode(self, words: Sequence[str]) -> list[bytes]:
        """Ids of each word, 4 bytes each. A word that is a special token's text is that token."""
        known = self.known
        found = list(map(known.get, words))
        missing = [w for w, ids in zip(words, found) if ids is None]
        if not missing:
            return found
        if len(known) + len(missing) > CACHED_WORDS:
            known.clear()
            known.update((w, ids) for w, ids in zip(words, found) if ids is not None)
        if not self._encode_line(missing):
            new = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
            known.update((w, struct.pack(f"<{len(e.ids)}I", *e.ids)) for w, e in zip(missing, new))
        return [known[w] if ids is None else ids for w, ids in zip(words, found)]

    def _encode_line(self, words: Sequence[str]) -> bool:
        """Encode words as one text where the vocabulary drops spaces and marks the ends of words, which is several times faster.
        False if the marks do not give every word back."""
        if self.ends is None or any(w in self.specials for w in words):
            return False
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words) or stops[-1] != len(ids):
            return False
        data, at = ids.tobytes(), [0, *(4 * stops).tolist()]
        self.known.update((w, data[a:b]) for w, a, b in zip(words, at[:-1], at[1:]))
        return True


@lru_cache(maxsize=4)
def encoder(path: str, normalized: bool) -> WordEncoder:
    return WordEncoder(path, normalized)


def flat_ids(per_word: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words end to end, and how many each has."""
    counts = np.fromiter(map(len, per_word), np.int64, len(per_word)) // 4
    return np.frombuffer(b"".join(per_word), "<u4"), counts


def spread(numbers: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words `numbers` end to end, and how many each of them has."""
    starts = np.cumsum(counts) - counts
    sizes = counts[numbers]
    total = int(sizes.sum())
    shift = np.repeat(starts[numbers] - (np.cumsum(sizes) - sizes), sizes)
    return flat[shift + np.arange(total)], sizes


def slices(texts: Sequence[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters; a longer text is alone."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)
