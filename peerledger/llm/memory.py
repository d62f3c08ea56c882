"""Handing back a Python worker's freed memory at the end of each task, since idle workers stay beside the next stage's for a minute."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def hand_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def frugal(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task over record batches that hands its freed memory back when it ends."""

    @wraps(task)
    def run(*args, **options) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(*args, **options)
        finally:
            hand_back()

    return run
