"""Numbering equal spans of integer arrays, many at a time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)

#: Values, and where spans of them begin and end.
Spans = tuple[np.ndarray, np.ndarray, np.ndarray]


def span_keys(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal spans have equal keys: a span's part of a running polynomial, shifted to a common exponent; all modulo 2**64."""
    powers = np.full(len(values) + 1, ODD, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    running = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=running[1:])
    return (running[end] - running[begin]) * powers[len(values) - begin]


def same_spans(values: np.ndarray, begin: np.ndarray, end: np.ndarray, model: np.ndarray) -> bool:
    """Is every span equal, value by value, to the span number `model` says?"""
    lengths = end - begin
    if not np.array_equal(lengths, lengths[model]):
        return False
    moved = np.flatnonzero(begin != begin[model])
    sizes = lengths[moved]
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.array_equal(values[at + np.repeat(begin[moved], sizes)], values[at + np.repeat(begin[model[moved]], sizes)])


def number_spans(columns: Sequence[Spans]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, first): rows of spans, one span per column, are numbered in order of first use; equal rows share a number. `first` is
    the first row of each number. Keys only group: rows are compared value by value, and numbered one by one should keys ever mislead."""
    import pandas as pd

    rows = len(columns[0][1])
    keys = np.zeros(rows, np.uint64)
    for values, begin, end in columns:
        keys = keys * MIX + span_keys(values, begin, end) * ODD + (end - begin).astype(np.uint64)
    numbers, found = pd.factorize(keys)
    first = np.empty(len(found), np.int64)
    first[numbers[::-1]] = np.arange(rows)[::-1]
    if all(same_spans(values, begin, end, first[numbers]) for values, begin, end in columns):
        return numbers.astype(np.int64), first
    known: dict[tuple[bytes, ...], int] = {}
    cells = [[values[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())] for values, begin, end in columns]
    numbers = np.fromiter((known.setdefault(row, len(known)) for row in zip(*cells)), np.int64, rows)
    first = np.empty(len(known), np.int64)
    first[numbers[::-1]] = np.arange(rows)[::-1]
    return numbers, first


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The integers start, start + 1, ... of each range, end to end."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
